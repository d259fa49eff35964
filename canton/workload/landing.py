"""Landed files in their odd forms, one election at a time, and the stop on failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from canton.functions import count_or_fail, to_long
from canton.operators.quality import (
    QualityError, Rule, enforce, not_negative, positive, run_checks, unique_check,
)
from canton.functions.text import zfill
from canton.operators.shaping import conform_area, filter_area, find_column, rename_positional
from canton.plans import layouts as L
from canton.plans.medallion import DEPARTMENT_WORDS
from canton.plans.votes import silver_votes
from canton.session import scratch_path
from canton.sources.ledger import Ledger, folder_name
from canton.sources import export_csv, export_json, read_delimited, read_wide_votes
from canton.workload.registry import query, table
from canton.workload.votes import REFRESHED, SILVER_SQL, SOURCE, bronze_votes, candidate_reference


@query(
    "strict_counts",
    """
    SELECT l_linenumber, CAST(sum(CASE WHEN l_linestatus = 'O' OR l_linenumber < 6 THEN l_quantity END) AS BIGINT) AS qty,
           count(*) FILTER (WHERE l_linestatus <> 'O' AND l_linenumber >= 6) AS n_unreadable
    FROM lineitem GROUP BY l_linenumber
    """,
)
def strict_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts as "12", "12.0", "12,0" and " 12 "; what cannot be read is counted, not summed."""
    whole = F.col("l_quantity").cast("long").cast("string")
    forms = (
        F.when((F.col("l_linestatus") != "O") & (F.col("l_linenumber") >= 6), F.lit("n/a"))
        .when(F.col("l_linenumber") % 4 == 0, F.concat(whole, F.lit(",0")))
        .when(F.col("l_linenumber") % 4 == 1, F.concat(whole, F.lit(".0")))
        .when(F.col("l_linenumber") % 4 == 2, F.concat(F.lit(" "), whole, F.lit(" ")))
        .otherwise(whole)
    )
    cells = table(spark, sf_dir, "lineitem").select("l_linenumber", forms.alias("text"))
    unreadable = F.col("text").isNotNull() & to_long(F.col("text"), decimal_comma=True).isNull()
    strict = F.when(~unreadable, count_or_fail(F.when(~unreadable, F.col("text"))))
    return cells.groupBy("l_linenumber").agg(
        F.sum(strict).alias("qty"), F.count_if(unreadable).alias("n_unreadable")
    )


@query(
    "typed_read",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
)
def typed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    orders = table(spark, sf_dir, "orders").select(*names)
    export_csv(orders, path)
    typed = T.StructType([T.StructField(f.name, f.dataType) for f in orders.schema])
    return read_delimited(spark, path, typed)


@query(
    "header_line_as_data",
    """
    SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS dep, CAST(s_suppkey AS VARCHAR) AS code,
           s_name AS nom_1, '€ ' || s_suppkey AS voix_1
    FROM supplier
    """,
)
def header_line_as_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file starts with a header line that is read as a row; it names no known area and drops out."""
    path = scratch_path(spark, "suppliers")
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" "), F.col("s_nationkey").cast("string")).alias("Code du departement"),
        F.col("s_suppkey").alias("code"), F.col("s_name").alias("nom"),
        F.concat(F.lit("\x80 "), F.col("s_suppkey").cast("string")).alias("voix"),
    )
    suppliers.write.options(sep=";", header=True, encoding="ISO-8859-1", ignoreLeadingWhiteSpace=False).csv(path)
    wide = read_wide_votes(spark, path, ["dep", "code"], ["nom", "voix"], 1, header=False)
    column = find_column(wide, ["dep"])
    known = table(spark, sf_dir, "nation").select(zfill(F.col("n_nationkey").cast("string"), 2).alias(column))
    return wide.withColumn(column, conform_area(F.col(column))).join(known, column, "left_semi").select(*wide.columns)


@query(
    "marked_header_read",
    "SELECT c_custkey AS customer, c_name AS name, c_mktsegment AS segment FROM customer",
)
def marked_header_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A byte-order mark before the first name, and columns without a name, renamed by place."""
    path = scratch_path(spark, "marked")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("﻿customer"), F.col("c_name").alias("Unnamed: 1"),
        F.col("c_mktsegment").alias("Unnamed: 2"),
    )
    export_csv(customers, path, sep=",")
    text = read_delimited(spark, path, sep=",")
    named = rename_positional(text, {"Unnamed: 1": "name", "Unnamed: 2": "segment", "Unnamed: 3": "none"})
    return named.withColumn("customer", to_long(F.col("customer")))


@query(
    "silver_of_one_election",
    f"""
    WITH {SILVER_SQL} SELECT {', '.join(L.SILVER_VOTES)} FROM votes
    WHERE annee_election = 1997 AND tour = 2 AND code_departement = '07'
    """,
)
def silver_of_one_election(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file without election columns: year and round are given by the caller."""
    bronze = bronze_votes(spark, sf_dir).where("annee_election = 1997 AND tour = 2")
    area = filter_area(bronze.drop(*L.ELECTION_KEYS), find_column(bronze, DEPARTMENT_WORDS), "07")
    return silver_votes(area, candidate_reference(spark), SOURCE, (1997, 2), REFRESHED, order="line")


@query(
    "enforced_report",
    """
    SELECT * FROM (
      SELECT 'passing' AS report, 'p_size_positive' AS check_name, true AS critical, count(*) AS checked, 0 AS failed, '' AS stopped FROM part
      UNION ALL SELECT 'passing', 'p_partkey_unique', true, count(*), 0, '' FROM part
      UNION ALL SELECT 'failing', 'large', true, count(*), count(*) FILTER (WHERE p_size > 40),
        'large: ' || count(*) FILTER (WHERE p_size > 40) || ' of ' || count(*) FROM part
      UNION ALL SELECT 'failing', 'p_retailprice_not_negative', false, count(*), 0,
        'large: ' || count(*) FILTER (WHERE p_size > 40) || ' of ' || count(*) FROM part)
    """,
)
def enforced_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports written as JSON, read back and enforced: one passes, one stops."""
    parts = table(spark, sf_dir, "part")
    reports = {
        "passing": run_checks(
            parts, [positive("p_size", critical=True)], unique_check(parts, ["p_partkey"], "p_partkey_unique")
        ),
        "failing": run_checks(
            parts, [Rule("large", F.col("p_size") > 40), not_negative("p_retailprice")]
        ),
    }
    out = None
    for name, report in reports.items():
        path = scratch_path(spark, f"report-{name}")
        export_json(report, path)
        stored = spark.read.schema("check_name string, critical boolean, checked long, failed long").json(path)
        try:
            enforce(stored)
            stopped = ""
        except QualityError as e:
            stopped = str(e)
        rows = stored.select(F.lit(name).alias("report"), "*", F.lit(stopped).alias("stopped"))
        out = rows if out is None else out.unionByName(rows)
    return out


_RELOADED_SQL = """
    SELECT year(o_orderdate) AS landed_year, o_custkey % 10 AS buyers, count(*) AS n_orders,
           CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS spent
    FROM orders
    WHERE year(o_orderdate) <> 1998 AND NOT (year(o_orderdate) = 1996 AND o_orderkey % 2 = 1)
    GROUP BY ALL
"""


@query("reloaded_files", _RELOADED_SQL)
def reloaded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed by year, loaded twice, then once more after corrections.

    1996 loses its odd orders, 1998 all of them; the other years are not read again.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderkey", "o_custkey", F.floor("o_totalprice").alias("price")
    )
    landed, path = scratch_path(spark, "landed"), scratch_path(spark, "loaded")
    ledger = Ledger(path, folder_name)
    schema = "o_orderkey long, o_custkey long, price long"

    def land(rows: DataFrame) -> None:
        write_csv = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write_csv.partitionBy("year").option("header", True).csv(landed)

    def load() -> int:
        return ledger.load(spark, f"{landed}/*/*.csv", lambda paths: spark.read.schema(schema).option("header", True).csv(paths))

    land(orders)
    load()
    load()
    corrected = orders.where("year = 1996 AND o_orderkey % 2 = 0")
    emptied = spark.createDataFrame([(1998, None, None, None)], f"year int, {schema}")
    land(corrected.unionByName(emptied))
    load()
    rows = ledger.table(spark).where("o_orderkey IS NOT NULL")
    return rows.groupBy(
        F.replace("landed_unit", F.lit("year="), F.lit("")).cast("long").alias("landed_year"), (F.col("o_custkey") % 10).alias("buyers")
    ).agg(F.count(F.lit(1)).alias("n_orders"), F.sum("price").alias("spent"))

"""Scalar functions, filters, enrichment and small grouped results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from canton.functions import (
    above_threshold, code_text, commune_id, contains_any, decimal_point, dot, election_label, half_even,
    insee_commune_id, iso_text, lstrip_zeros, numbered_id, pct, per_mille, sigmoid, slugify,
    timestamp_or_null, to_double, to_long, truncated, whole, year_of,
)
from canton.operators.aggregates import (
    common_rows, duel_label, first_and_sum, keep_first, key_drift, vanished_rows, winner_per_group,
)
from canton.operators.shaping import filter_area, pivot_sum
from canton.plans.features import wide_features
from canton.plans.votes import enrich
from canton.sources.literal import literal_table
from canton.sources.sinks import with_audit
from canton.workload.registry import query, sql_pct, sql_zfill, table


def cents(c: str):
    """Money as whole cents: sums do not depend on the order of the rows."""
    return F.rint(F.col(c) * 100).cast("long")


@query(
    "guarded_pct",
    f"""
    WITH o AS (
      SELECT o_custkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
             count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey, coalesce(n_orders, 0) AS n_orders,
           {sql_pct('n_urgent', 'n_final')} AS pct_plain,
           {sql_pct('n_urgent', 'n_final', True)} AS pct_guarded,
           CASE WHEN c_nationkey = 0 THEN 0.0 ELSE n_orders / CAST(c_nationkey AS DOUBLE) * 1000 END AS per_mille
    FROM customer LEFT JOIN o ON c_custkey = o_custkey
    """,
)
def guarded_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.count_if(F.col("o_orderstatus") == "F").alias("n_final"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = customers.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        "c_custkey",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        pct(F.col("n_urgent"), F.col("n_final")).alias("pct_plain"),
        pct(F.col("n_urgent"), F.col("n_final"), guard=True).alias("pct_guarded"),
        per_mille(F.col("n_orders"), F.col("c_nationkey")).alias("per_mille"),
    )


@query(
    "mixed_first_sum",
    """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn,
                      nullif(o_orderpriority, '5-LOW') AS prio FROM orders),
    f AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pn
          FROM r WHERE prio IS NOT NULL)
    SELECT s.o_custkey, s.o_orderstatus, f.prio AS priority, s.cents
    FROM (SELECT o_custkey, max(CASE WHEN rn = 1 THEN o_orderstatus END) AS o_orderstatus,
                 CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
          FROM r GROUP BY o_custkey) s
    LEFT JOIN f ON f.o_custkey = s.o_custkey AND f.pn = 1
    """,
)
def mixed_first_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumns(
        {"priority": F.nullif("o_orderpriority", F.lit("5-LOW")), "cents": cents("o_totalprice")}
    )
    order = F.struct("o_orderdate", "o_orderkey")
    return first_and_sum(orders, ["o_custkey"], ["o_orderstatus", "priority"], ["cents"], order)


@query(
    "keep_first",
    """
    SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
    WHERE rn = 1
    """,
)
def keep_first_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority"
    )
    return keep_first(orders, ["o_custkey"], F.struct("o_orderdate", "o_orderkey"))


_RAW_KEY = """
    c_nationkey || ' - ' || c_custkey ||
    CASE WHEN c_mktsegment = 'BUILDING' THEN '.0' WHEN c_mktsegment = 'FURNITURE' THEN ' ' ELSE '' END
"""


@query(
    "conform_keys",
    f"""
    WITH k AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS num, CAST(c_nationkey AS VARCHAR) AS nat FROM customer),
    p AS (SELECT *, {sql_zfill('num', 3)} AS num3, {sql_zfill('num', 5)} AS num5 FROM k)
    SELECT c_custkey, lpad(nat, 2, '0') || '-' || num3 AS id_commune,
           substr(num5, 1, 2) AS code_departement, substr(num5, 3) AS code_commune,
           substr(num5, 1, 2) || '-' || substr(num5, 3) AS insee_key,
           num3 AS padded, ltrim(num3, '0') AS unpadded, 'CUST_' || {sql_zfill('num', 4)} AS id_member,
           '2022_T' || nat AS election
    FROM p
    """,
)
def conform_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("c_custkey").cast("string")
    insee = insee_commune_id(F.concat(number, F.lit("\t")))
    padded = code_text(F.concat(F.lit(" "), number, F.lit(".0")), 3)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        commune_id(F.expr(_RAW_KEY)).alias("id_commune"),
        F.substring_index(insee, "-", 1).alias("code_departement"),
        F.substring_index(insee, "-", -1).alias("code_commune"),
        insee.alias("insee_key"),
        padded.alias("padded"),
        lstrip_zeros(padded).alias("unpadded"),
        numbered_id(F.col("c_custkey"), "CUST_", 4).alias("id_member"),
        election_label(F.lit(2022), F.col("c_nationkey")).alias("election"),
    )


@query(
    "slugify_labels",
    """
    SELECT p_partkey,
           trim(regexp_replace(translate(lower(trim(' Été d''' || p_name || ' (' || p_type || ')/À-Çôte  ')),
             'éèêëàâäîïôöùûüç''- ()/', 'eeeeaaaiioouuuc______'), '_+', '_', 'g'), '_') AS slug,
           trim(regexp_replace(translate(lower(p_brand || ' / ' || p_type), '''- ()/', '______'), '_+', '_', 'g'), '_') AS brand_slug,
           contains(lower(p_name), 'widget') OR contains(lower(p_name), 'ring') AS has_keyword
    FROM part
    """,
)
def slugify_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = F.concat(F.lit(" Été d'"), "p_name", F.lit(" ("), "p_type", F.lit(")/À-Çôte  "))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        slugify(messy).alias("slug"),
        slugify(F.concat_ws(" / ", "p_brand", "p_type")).alias("brand_slug"),
        contains_any(F.col("p_name"), ["widget", "ring"]).alias("has_keyword"),
    )


@query(
    "coerce_numbers",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CAST(trunc(l_extendedprice) AS BIGINT) AS price_whole,
           CAST(round_even(l_extendedprice, 0) AS BIGINT) AS price_rounded,
           CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS qty_or_null,
           CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE l_quantity END AS qty_or_zero,
           CASE WHEN l_returnflag = 'N' THEN -1 ELSE CAST(l_quantity AS BIGINT) END AS qty_long,
           CAST(l_quantity AS BIGINT) AS qty_strict,
           CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS jvm_suffix
    FROM lineitem
    """,
)
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    qty = F.when(F.col("l_returnflag") == "N", F.lit(" n/a ")).otherwise(
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"))
    )
    number = F.col("l_linenumber").cast("string")
    suffixed = F.when(F.col("l_linestatus") == "F", F.concat(number, F.lit("d"))).otherwise(number)
    value = to_double(decimal_point(price))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        value.alias("price"),
        truncated(value).alias("price_whole"),
        whole(value).alias("price_rounded"),
        to_double(qty).alias("qty_or_null"),
        to_double(qty, 0.0).alias("qty_or_zero"),
        to_long(qty, -1).alias("qty_long"),
        F.col("l_quantity").cast("long").alias("qty_strict"),
        to_double(suffixed).alias("jvm_suffix"),
    )


@query(
    "json_number",
    "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events",
)
def json_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", to_long(F.get_json_object("props", "$.k")).alias("k")
    )


@query(
    "timestamps_year",
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS coerced,
           CASE WHEN event_type = 'error' THEN NULL ELSE CAST(year(ts) AS INTEGER) END AS event_year,
           strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso
    FROM events
    """,
)
def timestamps_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        timestamp_or_null(text).cast("timestamp_ntz").alias("coerced"),
        year_of(text).alias("event_year"),
        iso_text(F.col("ts")).alias("iso"),
    )


@query(
    "area_filter",
    """
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_nationkey = 7
    """,
)
def area_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.expr(
        "CASE c_mktsegment WHEN 'BUILDING' THEN ' ' || c_nationkey WHEN 'FURNITURE' THEN '0' || c_nationkey "
        "WHEN 'MACHINERY' THEN '00' || c_nationkey ELSE c_nationkey || '\t' END"
    )
    customers = table(spark, sf_dir, "customer").withColumn("area", code)
    return filter_area(customers, "area", "07").select("c_custkey", "c_name", "c_mktsegment")


@query(
    "enrich_reference",
    """
    WITH ref(segment, grp) AS (VALUES ('BUILDING', 'works'), ('FURNITURE', 'home'), ('HOUSEHOLD', 'home'), ('MACHINERY', 'works'))
    SELECT c_custkey, c_mktsegment, grp AS segment_group FROM customer LEFT JOIN ref ON c_mktsegment = segment
    """,
)
def enrich_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [
        (" BUILDING", "works", 1), ("FURNITURE ", "home", 2), ("HOUSEHOLD", "home", 3),
        ("MACHINERY", "works", 4), ("MACHINERY", "other", 5),
    ]
    reference = literal_table(spark, ["segment", "segment_group", "line"], rows)
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat("c_mktsegment", F.lit(" ")).alias("c_mktsegment")
    )
    return enrich(customers, reference, {"c_mktsegment": "segment"}, "line").select(
        "c_custkey", "c_mktsegment", "segment_group"
    )


@query(
    "pivot_sum",
    """
    SELECT user_id, CAST(day(ts) AS INTEGER) AS event_day,
    """
    + ", ".join(
        f"CAST(sum(CASE WHEN event_type = '{e}' THEN CAST(round(value * 100) AS BIGINT) END) AS BIGINT) AS {e}_sum"
        for e in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY ALL",
)
def pivot_sum_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id",
        F.dayofmonth("ts").alias("Event Day"),
        F.initcap(F.concat("event_type", F.lit("-sum"))).alias("kind"),
        cents("value").alias("cents"),
    )
    return pivot_sum(events, ["user_id", "Event Day"], "kind", "cents")


@query(
    "features_last_value",
    "SELECT user_id, "
    + ", ".join(
        f"max(CASE WHEN event_type = '{e}' THEN value END) AS max_{e}, "
        f"max(CASE WHEN event_type = '{e}' AND day(ts) <= 10 THEN value END) AS early_{e}"
        for e in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id",
)
def features_last_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = {}
    for e in ("click", "error", "purchase", "signup", "view"):
        features[f"max_{e}"] = f"CASE WHEN event_type = '{e}' THEN value END"
        features[f"early_{e}"] = f"CASE WHEN event_type = '{e}' AND day(ts) <= 10 THEN value END"
    return wide_features(table(spark, sf_dir, "events"), ["user_id"], features)


def segment_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per nation, year and segment; a busy customer joins as one row a year."""
    orders = table(spark, sf_dir, "orders").groupBy(
        "o_custkey", F.year("o_orderdate").alias("order_year")
    ).agg(F.count(F.lit(1)).alias("n"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "order_year", "c_mktsegment")
        .agg(F.sum("n").alias("n_orders"))
    )


_SALES_SQL = """
    sales AS (SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, c_mktsegment, count(*) AS n_orders
              FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
"""


@query(
    "winner_per_group",
    f"""
    WITH {_SALES_SQL}
    SELECT c_nationkey, order_year, c_mktsegment, n_orders FROM (
      SELECT *, row_number() OVER (PARTITION BY c_nationkey, order_year ORDER BY n_orders DESC, c_mktsegment DESC) AS rn
      FROM sales) WHERE rn = 1
    """,
)
def winner_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = segment_sales(spark, sf_dir)
    return winner_per_group(sales, ["c_nationkey", "order_year"], "c_mktsegment", "n_orders")


@query(
    "winner_among_two",
    f"""
    WITH {_SALES_SQL}
    SELECT c_nationkey, order_year, c_mktsegment, n_orders FROM (
      SELECT *, row_number() OVER (PARTITION BY c_nationkey, order_year
               ORDER BY n_orders DESC, c_mktsegment = 'BUILDING' DESC) AS rn
      FROM sales WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) WHERE rn = 1
    """,
)
def winner_among_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("c_mktsegment") == "BUILDING"
    return winner_per_group(
        segment_sales(spark, sf_dir), ["c_nationkey", "order_year"], "c_mktsegment", "n_orders",
        tie=first, among=["BUILDING", "MACHINERY"],
    )


@query(
    "duel_label",
    f"""
    WITH {_SALES_SQL}
    SELECT c_nationkey, order_year,
           CAST(coalesce(max(CASE WHEN c_mktsegment = 'BUILDING' THEN n_orders END), -1)
              > coalesce(max(CASE WHEN c_mktsegment = 'MACHINERY' THEN n_orders END), -1) AS INTEGER) AS building_wins
    FROM sales WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY ALL
    """,
)
def duel_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duel_label(
        segment_sales(spark, sf_dir), ["c_nationkey", "order_year"], "c_mktsegment", "n_orders",
        "BUILDING", "MACHINERY", "building_wins",
    )


def _buyers(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    start, end = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
    return orders.where((F.col("o_orderdate") >= start) & (F.col("o_orderdate") < end)).select(
        F.col("o_custkey").alias("custkey"), "o_orderkey"
    )


@query(
    "key_drift",
    """
    WITH a AS (SELECT DISTINCT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 1996),
    b AS (SELECT DISTINCT o_custkey AS custkey FROM orders WHERE year(o_orderdate) = 1997)
    SELECT coalesce(a.custkey, b.custkey) AS custkey,
           CASE WHEN b.custkey IS NULL THEN 'only_first' WHEN a.custkey IS NULL THEN 'only_second' ELSE 'both' END AS status
    FROM a FULL JOIN b ON a.custkey = b.custkey
    """,
)
def key_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_drift(_buyers(spark, sf_dir, 1996), _buyers(spark, sf_dir, 1997), ["custkey"])


@query(
    "common_keys",
    """
    SELECT o_custkey AS custkey, o_orderkey FROM orders WHERE year(o_orderdate) = 1996
      AND o_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)
    """,
)
def common_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return common_rows(_buyers(spark, sf_dir, 1996), _buyers(spark, sf_dir, 1997), ["custkey"])


@query(
    "vanished_keys",
    """
    SELECT o_custkey AS custkey, o_orderkey FROM orders WHERE year(o_orderdate) = 1996
      AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)
    """,
)
def vanished_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vanished_rows(_buyers(spark, sf_dir, 1996), _buyers(spark, sf_dir, 1997), ["custkey"])


@query(
    "audit_columns",
    """
    SELECT c_custkey, 'https://example.org/customers' AS extraction_source_url,
           '2024-01-01T00:00:00' AS ingestion_timestamp, 'customer.parquet' AS source_file_name
    FROM customer
    """,
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return with_audit(customers, "https://example.org/customers", "2024-01-01T00:00:00")


@query(
    "topk_abs",
    """
    SELECT c_custkey, c_acctbal, abs(c_acctbal - 5000) AS distance FROM customer
    ORDER BY distance DESC, c_custkey LIMIT 10
    """,
)
def topk_abs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_acctbal", F.abs(F.col("c_acctbal") - 5000).alias("distance"))
        .orderBy(F.desc("distance"), "c_custkey")
        .limit(10)
    )


@query(
    "score_rows",
    """
    WITH z AS (
      SELECT doc_id, n_chars / 1000.0 AS size_k, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END AS english FROM documents),
    s AS (SELECT doc_id, size_k * 0.25 + english * -0.5 + -0.75 AS score FROM z)
    SELECT doc_id, round_even((1 / (1 + exp(-greatest(-50.0, least(50.0, CAST(score AS DOUBLE)))))) * 1000000, 0) / 1000000 AS probability,
           CAST(score >= 0 AS INTEGER) AS predicted
    FROM s
    """,
)
def score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    english = F.when(F.col("lang") == "en", 1.0).otherwise(0.0)
    features = F.array((F.col("n_chars") / 1000).cast("double"), english, F.lit(1.0))
    weights = F.array(F.lit(0.25), F.lit(-0.5), F.lit(-0.75))
    p = sigmoid(dot(features, weights))
    return table(spark, sf_dir, "documents").select(
        "doc_id", half_even(p, 6).alias("probability"), above_threshold(p).alias("predicted")
    )

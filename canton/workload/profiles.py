"""Profiles and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from canton.functions import half_even
from canton.operators.aggregates import null_report, profile, sorted_values
from canton.operators.quality import (
    Rule, cascade, ceiling_check, checked_write, fill_median, fill_unknown, join_reports, merged_reports,
    not_negative, positive, reference_check, run_checks, unique_check, within_percent,
)
from canton.session import scratch_path
from canton.sources.sinks import read_table
from canton.workload.registry import query, table
from canton.workload.votes import SILVER_SQL, silver_table


@query(
    "null_report",
    """
    WITH d AS (SELECT doc_id, nullif(lang, 'en') AS foreign_lang, source, n_chars, quality, toxic
               FROM documents LEFT JOIN labels USING (doc_id)),
    c AS (SELECT count(*) FILTER (WHERE doc_id IS NULL) AS a, count(*) FILTER (WHERE foreign_lang IS NULL) AS b,
                 count(*) FILTER (WHERE source IS NULL) AS c, count(*) FILTER (WHERE n_chars IS NULL) AS d,
                 count(*) FILTER (WHERE quality IS NULL) AS e, count(*) FILTER (WHERE toxic IS NULL) AS f FROM d)
    SELECT * FROM (SELECT 'doc_id' AS column_name, a AS missing FROM c UNION ALL SELECT 'foreign_lang', b FROM c
      UNION ALL SELECT 'source', c FROM c UNION ALL SELECT 'n_chars', d FROM c
      UNION ALL SELECT 'quality', e FROM c UNION ALL SELECT 'toxic', f FROM c) WHERE missing > 0
    """,
)
def null_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.nullif("lang", F.lit("en")).alias("foreign_lang"), "source", "n_chars"
    )
    return null_report(documents.join(table(spark, sf_dir, "labels"), "doc_id", "left"))


_PROFILED = ("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")


@query(
    "distinct_profile",
    " UNION ALL ".join(
        f"SELECT count(*) AS total_rows, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM lineitem"
        for c in _PROFILED
    ),
)
def distinct_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(table(spark, sf_dir, "lineitem"), _PROFILED)


@query(
    "sorted_values",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders WHERE o_orderdate IS NOT NULL ORDER BY 1",
)
def sorted_values_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("order_year"))
    return sorted_values(years, "order_year")


@query(
    "quality_checks",
    """
    WITH l AS (SELECT l_discount * 100 AS discount_pct, l_quantity, l_extendedprice, l_tax FROM lineitem),
    o AS (SELECT o_orderkey, count(*) AS n FROM orders GROUP BY 1),
    k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2),
    s AS (SELECT l_orderkey, sum(l_quantity) AS q, count(*) * 25 AS top FROM lineitem GROUP BY 1)
    SELECT 'discount_pct_in_0_100' AS check_name, true AS critical, count(*) AS checked,
           count(*) FILTER (WHERE NOT discount_pct BETWEEN 0 AND 100) AS failed FROM l
    UNION ALL SELECT 'l_extendedprice_ge_l_quantity_ge_l_tax', true, count(*),
           count(*) FILTER (WHERE l_extendedprice < l_quantity OR l_quantity < l_tax) FROM l
    UNION ALL SELECT 'l_tax_not_negative', false, count(*), count(*) FILTER (WHERE l_tax < 0) FROM l
    UNION ALL SELECT 'l_quantity_positive', false, count(*), count(*) FILTER (WHERE l_quantity <= 0) FROM l
    UNION ALL SELECT 'large_line', false, count(*), count(*) FILTER (WHERE l_quantity > 45) FROM l
    UNION ALL SELECT 'order_unique', true, CAST(sum(n) AS BIGINT), count(*) FILTER (WHERE n > 1) FROM o
    UNION ALL SELECT 'line_unique', true, CAST(sum(n) AS BIGINT), count(*) FILTER (WHERE n > 1) FROM k
    UNION ALL SELECT 'line_has_rare_order', true, (SELECT count(*) FROM lineitem),
           (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))
    UNION ALL SELECT 'order_ceiling', false, count(*), count(*) FILTER (WHERE q > top) FROM s
    """,
)
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    rules = [
        within_percent("discount_pct"),
        cascade("l_extendedprice", "l_quantity", "l_tax"),
        not_negative("l_tax"),
        positive("l_quantity"),
        Rule("large_line", F.col("l_quantity") > 45, critical=False),
    ]
    tops = lines.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), (F.count(F.lit(1)) * 25).alias("top")
    )
    return run_checks(
        lines.withColumn("discount_pct", F.col("l_discount") * 100),
        rules,
        unique_check(orders, ["o_orderkey"], "order_unique"),
        unique_check(lines, ["l_orderkey", "l_linenumber"], "line_unique"),
        reference_check(
            lines,
            orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey")),
            ["l_orderkey"],
            "line_has_rare_order",
        ),
        ceiling_check(tops, ["l_orderkey"], "quantity", "top", "order_ceiling", critical=False),
    )


_VOTE_QUALITY_SQL = f"""
    WITH {SILVER_SQL},
    g AS (SELECT code_departement, code_commune, libelle_commune, annee_election, tour, sum(voix) AS v, max(exprimes) AS top
          FROM votes GROUP BY ALL)
    SELECT 'pct_vot_ins_in_0_100' AS check_name, true AS critical, count(*) AS checked,
           count(*) FILTER (WHERE NOT pct_vot_ins BETWEEN 0 AND 100) AS failed FROM votes
    UNION ALL SELECT 'inscrits_ge_votants_ge_exprimes', true, count(*),
           count(*) FILTER (WHERE inscrits < votants OR votants < exprimes) FROM votes
    UNION ALL SELECT 'voix_not_negative', false, count(*), count(*) FILTER (WHERE voix < 0) FROM votes
    UNION ALL SELECT 'voix_le_exprimes', true, count(*), count(*) FILTER (WHERE v > top) FROM g
    """


@query("vote_quality", _VOTE_QUALITY_SQL)
def vote_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = silver_table(spark, sf_dir)
    commune = ["code_departement", "code_commune", "libelle_commune", "annee_election", "tour"]
    return run_checks(
        votes,
        [within_percent("pct_vot_ins"), cascade("inscrits", "votants", "exprimes"), not_negative("voix")],
        ceiling_check(votes, commune, "voix", "exprimes", "voix_le_exprimes"),
    )


@query("observed_quality", _VOTE_QUALITY_SQL)
def observed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report with the row rules counted by the tasks that write the silver votes, in two halves."""
    rules = [within_percent("pct_vot_ins"), cascade("inscrits", "votants", "exprimes"), not_negative("voix")]
    votes, path = silver_table(spark, sf_dir), scratch_path(spark, "silver")
    early = F.col("annee_election") < 1998
    reports = [
        checked_write(votes.where(half), f"{path}/{name}", rules)
        for name, half in (("early", early), ("late", ~early))
    ]
    stored = read_table(spark, [f"{path}/early", f"{path}/late"])
    commune = ["code_departement", "code_commune", "libelle_commune", "annee_election", "tour"]
    return join_reports(
        merged_reports(*reports), ceiling_check(stored, commune, "voix", "exprimes", "voix_le_exprimes")
    )


@query(
    "null_policy",
    """
    WITH d AS (SELECT doc_id, nullif(lang, 'en') AS lang, CASE WHEN lang = 'de' THEN NULL ELSE n_chars END AS n FROM documents)
    SELECT doc_id, coalesce(lang, 'DVR') AS lang,
           round_even(coalesce(n, (SELECT median(n) FROM d)) * 100, 0) / 100 AS n_chars
    FROM d
    """,
)
def null_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.nullif("lang", F.lit("en")).alias("lang"),
        F.when(F.col("lang") != "de", F.col("n_chars")).cast("double").alias("n_chars"),
    )
    filled = fill_median(fill_unknown(documents, {"lang": "DVR"}), "n_chars")
    return filled.withColumn("n_chars", half_even(F.col("n_chars")))

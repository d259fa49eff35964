"""Dimensions, facts and star queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from canton.operators.dimensions import lookup_key, surrogate_key
from canton.plans import layouts as L
from canton.plans.safety import conform_safety, wide_safety
from canton.plans.stars import build_safety_star, build_star
from canton.session import scratch_path
from canton.sources.sinks import read_table, write_table
from canton.workload.basics import cents
from canton.workload.registry import query, sql_zfill, table
from canton.workload.votes import SILVER_SQL, silver_table

LOADED = "2024-02-01T00:00:00.000000"


@query(
    "dim_distinct_keys",
    """
    SELECT 'SEC_' || lpad(CAST(row_number() OVER (ORDER BY p_type, p_brand) AS VARCHAR), 3, '0') AS id_member,
           p_type, p_brand
    FROM (SELECT DISTINCT p_type, p_brand FROM part)
    """,
)
def dim_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate_key(table(spark, sf_dir, "part"), ["p_type", "p_brand"], "id_member", "SEC_")


@query(
    "sequential_keys",
    f"""
    SELECT 'C' || {sql_zfill("CAST(n AS VARCHAR)", 5)} AS id_customer, c_mktsegment, c_name FROM (
      SELECT row_number() OVER (ORDER BY c_mktsegment, c_name) AS n, c_mktsegment, c_name FROM customer)
    """,
)
def sequential_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return surrogate_key(customers, ["c_mktsegment", "c_name"], "id_customer", "C", 5)


@query(
    "fact_key_lookup",
    """
    WITH p AS (SELECT p_partkey, p_brand, nullif(p_type, 'SMALL') AS kind FROM part),
    d AS (SELECT 'K' || lpad(CAST(row_number() OVER (ORDER BY kind NULLS FIRST, p_brand) AS VARCHAR), 3, '0') AS id_kind,
                 kind, p_brand FROM (SELECT DISTINCT kind, p_brand FROM p))
    SELECT p_partkey, p.kind, id_kind FROM p LEFT JOIN d
      ON p.kind IS NOT DISTINCT FROM d.kind AND p.p_brand = d.p_brand
    """,
)
def fact_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.nullif("p_type", F.lit("SMALL")).alias("kind")
    )
    dim = surrogate_key(parts, ["kind", "p_brand"], "id_kind", "K")
    return lookup_key(parts, dim, ["kind", "p_brand"]).select("p_partkey", "kind", "id_kind")


@query(
    "gold_dim_election",
    f"WITH {SILVER_SQL} SELECT DISTINCT annee_election || '_T' || tour AS id_election, annee_election, tour FROM votes",
)
def gold_dim_election(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_star(silver_table(spark, sf_dir)).dim_election


_AREA = "code_departement, libelle_departement, code_commune, libelle_commune"


@query(
    "gold_dim_commune",
    f"""
    WITH {SILVER_SQL},
    labels AS (SELECT code_departement || '-' || code_commune AS id_commune, {_AREA}, max(annee_election) AS last_year
               FROM votes GROUP BY ALL)
    SELECT id_commune, {_AREA} FROM (
      SELECT *, row_number() OVER (PARTITION BY id_commune ORDER BY last_year DESC, libelle_commune DESC) AS rn FROM labels)
    WHERE rn = 1
    """,
)
def gold_dim_commune(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_star(silver_table(spark, sf_dir)).dim_commune


@query(
    "gold_commune_history",
    f"""
    WITH {SILVER_SQL}
    SELECT code_departement || '-' || code_commune AS id_commune, {_AREA},
           min(annee_election) AS first_year, max(annee_election) AS last_year
    FROM votes GROUP BY ALL
    """,
)
def gold_commune_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_star(silver_table(spark, sf_dir)).commune_history


_CANDIDATES = """
    members AS (SELECT DISTINCT nom, prenom, sexe, nuance FROM votes),
    dim_candidat AS (
      SELECT 'CAND_' || lpad(CAST(row_number() OVER (ORDER BY nom, prenom, sexe, nuance NULLS FIRST) AS VARCHAR), 3, '0') AS id_candidat, *
      FROM members)
"""


@query("gold_dim_candidate", f"WITH {SILVER_SQL}, {_CANDIDATES} SELECT * FROM dim_candidat")
def gold_dim_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_star(silver_table(spark, sf_dir)).dim_candidat


@query(
    "gold_fact_votes",
    f"""
    WITH {SILVER_SQL}, {_CANDIDATES}
    SELECT code_departement || '-' || code_commune AS id_commune, annee_election || '_T' || tour AS id_election,
           id_candidat, {', '.join(L.VOTE_MEASURES)}, '{LOADED}' AS date_integration_gold
    FROM votes v JOIN dim_candidat d ON v.nom = d.nom AND v.prenom = d.prenom AND v.sexe = d.sexe
     AND v.nuance IS NOT DISTINCT FROM d.nuance
    """,
)
def gold_fact_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_star(silver_table(spark, sf_dir), LOADED).fact_resultats


def bronze_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text indicator rows in the source layout: users are communes, the
    day of the month gives the year, the event type the indicator."""
    areas = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_nationkey").cast("string").alias("nation")
    )
    rows = table(spark, sf_dir, "events").groupBy(
        "user_id", (2021 + F.dayofmonth("ts") % 3).alias("year"), "event_type"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(cents("value")).alias("cents"))
    area = F.concat(
        F.lpad(F.coalesce("nation", F.lit("99")), 2, "0"),
        F.expr(sql_zfill("CAST(user_id AS STRING)", 3)),
    )
    code = F.when(F.length(area) == 5, F.regexp_replace(area, "^0", "")).otherwise(area)
    serious = F.col("event_type").isin("click", "view")
    rate = (F.col("cents") / 100).cast("double").cast("string")
    source = {
        "CODGEO_2025": code,
        "annee": F.concat(F.col("year").cast("string"), F.lit("-01-01")),
        "indicateur": F.concat(F.lit(" "), F.initcap("event_type"), F.lit(" d'été")),
        "unite_de_compte": F.when(serious, "Infraction").otherwise("Victime"),
        "nombre": F.col("n").cast("string"),
        "taux_pour_mille": F.when((F.col("event_type") == "error") & (F.col("n") < 8), "ndiff").otherwise(rate),
        "est_diffuse": F.lit("diff "),
        "insee_pop": (F.col("user_id") * 10 + F.col("year")).cast("string"),
        "insee_pop_millesime": F.lit("2020-01-01"),
        "insee_log": (F.col("user_id") * 3).cast("string"),
        "insee_log_millesime": F.lit("inconnu"),
        "complement_info_nombre": F.lit(""),
        "complement_info_taux": F.lit("0,5"),
        "timestamp_processing": F.lit("2024-05-01 10:00:00"),
        " bronze_load_date ": F.lit("2024-05-02"),
    }
    return rows.join(areas, "user_id", "left").select(*[c.alias(n) for n, c in source.items()])


SAFETY_SQL = """
    grouped AS (
      SELECT user_id, 2021 + day(ts) % 3 AS annee, event_type, count(*) AS n,
             CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
      FROM events GROUP BY ALL),
    safety AS (
      SELECT CASE WHEN s_nationkey IS NULL THEN '99' ELSE lpad(CAST(s_nationkey AS VARCHAR), 2, '0') END AS code_departement,
             CASE WHEN length(CAST(user_id AS VARCHAR)) < 3 THEN lpad(CAST(user_id AS VARCHAR), 3, '0') ELSE CAST(user_id AS VARCHAR) END AS code_commune,
             CAST(annee AS INTEGER) AS annee,
             upper(event_type[1]) || event_type[2:] || ' d''été' AS indicateur,
             CASE WHEN event_type IN ('click', 'view') THEN 'Infraction' ELSE 'Victime' END AS unite_de_compte,
             CAST(n AS DOUBLE) AS nombre,
             CASE WHEN event_type = 'error' AND n < 8 THEN NULL ELSE cents / 100.0 END AS taux_pour_mille,
             'diff' AS est_diffuse, CAST(user_id * 10 + annee AS DOUBLE) AS insee_pop,
             CAST('2020-01-01' AS TIMESTAMP) AS insee_pop_millesime, CAST(user_id * 3 AS DOUBLE) AS insee_log,
             CAST(NULL AS TIMESTAMP) AS insee_log_millesime, CAST(NULL AS DOUBLE) AS complement_info_nombre,
             CAST(NULL AS DOUBLE) AS complement_info_taux, 'securite_commune' AS source_dataset,
             CAST('2024-05-01 10:00:00' AS TIMESTAMP) AS source_dataset_timestamp,
             CAST('2024-05-02' AS TIMESTAMP) AS date_refresh
      FROM grouped LEFT JOIN supplier ON user_id = s_suppkey)
"""


def naive_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, the type of the given tables."""
    return df.select(
        *[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes]
    )


def silver_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_safety(spark, sf_dir)
    return conform_safety(bronze)


def safety_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver table that the wide table and the star read."""
    path = scratch_path(spark, "silver-safety")
    write_table(silver_safety(spark, sf_dir), path)
    return read_table(spark, path)


@query("silver_safety", f"WITH {SAFETY_SQL} SELECT *, code_departement || code_commune AS code_insee_commune FROM safety")
def silver_safety_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(silver_safety(spark, sf_dir))


@query(
    "wide_safety",
    f"""
    WITH {SAFETY_SQL}
    SELECT code_departement, code_commune, code_departement || code_commune AS code_insee_commune, annee, insee_pop,
    """
    + ", ".join(
        f"sum(CASE WHEN indicateur = '{e} d''été' THEN round_even(coalesce(taux_pour_mille, 0) * 100, 0) / 100 END) AS {e.lower()}_d_été"
        for e in ("Click", "Error", "Purchase", "Signup", "View")
    )
    + " FROM safety GROUP BY ALL",
)
def wide_safety_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_safety(safety_table(spark, sf_dir))


_SAFETY_DIM = """
    dim AS (SELECT 'SEC_' || lpad(CAST(row_number() OVER (ORDER BY indicateur, unite_de_compte) AS VARCHAR), 3, '0') AS id_indicateur_securite,
                   indicateur, unite_de_compte FROM (SELECT DISTINCT indicateur, unite_de_compte FROM safety))
"""


@query("gold_dim_indicator", f"WITH {SAFETY_SQL}, {_SAFETY_DIM} SELECT * FROM dim")
def gold_dim_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_safety_star(safety_table(spark, sf_dir)).dim_indicateur_securite


@query(
    "gold_fact_safety",
    f"""
    WITH {SAFETY_SQL}, {_SAFETY_DIM}
    SELECT code_departement || '-' || code_commune AS id_commune, annee, id_indicateur_securite, code_departement,
           code_commune, code_departement || code_commune AS code_insee_commune, nombre, taux_pour_mille, est_diffuse,
           CAST(insee_pop AS BIGINT) AS insee_pop, CAST(insee_log AS BIGINT) AS insee_log,
           complement_info_nombre, complement_info_taux, source_dataset, source_dataset_timestamp, date_refresh
    FROM safety JOIN dim USING (indicateur, unite_de_compte)
    """,
)
def gold_fact_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_times(build_safety_star(safety_table(spark, sf_dir)).fact_securite)


@query(
    "star_query_1",
    """
    SELECT n_name, c_name, o_orderkey, o_totalprice
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA' AND c_mktsegment = 'BUILDING' AND o_orderpriority = '1-URGENT'
    """,
)
def star_query_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .where(
            (F.col("r_name") == "ASIA")
            & (F.col("c_mktsegment") == "BUILDING")
            & (F.col("o_orderpriority") == "1-URGENT")
        )
        .select("n_name", "c_name", "o_orderkey", "o_totalprice")
    )


@query(
    "star_query_2",
    """
    SELECT s_name, CAST(year(l_shipdate) AS INTEGER) AS ship_year, p_type, l_quantity, l_extendedprice
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
    WHERE s_nationkey = 7 ORDER BY s_name, ship_year
    """,
)
def star_query_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .where(F.col("s_nationkey") == 7)
        .select(
            "s_name", F.year("l_shipdate").alias("ship_year"), "p_type", "l_quantity", "l_extendedprice"
        )
        .orderBy("s_name", "ship_year")
    )


@query(
    "star_query_3",
    """
    SELECT p_brand, p_type, count(*) AS n_lines, avg(l_quantity) AS avg_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 20
    GROUP BY p_brand, p_type ORDER BY avg_quantity DESC
    """,
)
def star_query_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are summed per part first, so a hot part joins as a single row."""
    per_part = (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_quantity") >= 20)
        .groupBy("l_partkey")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    )
    return (
        per_part.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand", "p_type")
        .agg(F.sum("n").alias("n_lines"), (F.sum("quantity") / F.sum("n")).alias("avg_quantity"))
        .orderBy(F.desc("avg_quantity"))
    )

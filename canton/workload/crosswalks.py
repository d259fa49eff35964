"""Units that vanish and appear between periods. Customers play communes, the
years of their orders elections, nations areas; the orders' price is the size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from canton.operators.crosswalk import COMMON_WORDS, WEIGHT, carried_forward, latest_units, merge_links
from canton.session import stored_table
from canton.workload.registry import query, table


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per year and customer with orders; names of a few words, some shared."""
    orders = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("period")
    ).agg(F.sum(F.floor("o_totalprice")).cast("long").alias("size"), F.count(F.lit(1)).alias("n_orders"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_nationkey").alias("area"),
        F.concat(
            F.lit("Saint-"), F.initcap("c_mktsegment"), F.lit(" sur "), F.lit("N"), (F.col("c_custkey") % 40).cast("string")
        ).alias("name"),
    )
    return orders.join(customers, "key").select("period", "area", "key", "name", "size", "n_orders")


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_table(_units(spark, sf_dir), "units")


_COMMON = ", ".join(f"'{w}'" for w in COMMON_WORDS)
_LINKS_SQL = f"""
    units AS (
      SELECT period, c_nationkey AS area, CAST(key AS VARCHAR) AS key, size, n_orders,
             list_filter([lower(c_mktsegment), 'n' || (key % 40)], lambda w: w NOT IN ({_COMMON})) AS words
      FROM (SELECT o_custkey AS key, CAST(year(o_orderdate) AS INTEGER) AS period,
                   CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS size, count(*) AS n_orders
            FROM orders GROUP BY ALL) JOIN customer ON c_custkey = key),
    periods AS (SELECT period, lag(period) OVER (ORDER BY period) AS before, lead(period) OVER (ORDER BY period) AS after
                FROM (SELECT DISTINCT period FROM units)),
    gone AS (SELECT u.*, after AS step FROM units u JOIN periods p USING (period)
             WHERE after IS NOT NULL AND NOT EXISTS (SELECT 1 FROM units x WHERE x.area = u.area AND x.key = u.key AND x.period = p.after)),
    fresh AS (SELECT u.*, period AS step FROM units u JOIN periods p USING (period)
              WHERE before IS NOT NULL AND NOT EXISTS (SELECT 1 FROM units x WHERE x.area = u.area AND x.key = u.key AND x.period = p.before)),
    gone_words AS (SELECT step, area, key, size, unnest(words) AS word FROM gone),
    fresh_words AS (SELECT step, area, key, size, unnest(words) AS word FROM fresh),
    holders AS (SELECT step, area, word, {WEIGHT} // count(*) AS weight
                FROM (SELECT step, area, word FROM gone_words UNION ALL SELECT step, area, word FROM fresh_words) GROUP BY ALL),
    pairs AS (SELECT step, area, g.key, f.key AS to_key, max(f.size) AS to_size, CAST(sum(weight) AS BIGINT) AS score
              FROM gone_words g JOIN fresh_words f USING (step, area, word) JOIN holders USING (step, area, word)
              WHERE g.size <= f.size * (1 + CAST(0.1 AS DOUBLE)) GROUP BY ALL),
    named AS (SELECT step, area, key, to_key, score FROM pairs
              QUALIFY row_number() OVER (PARTITION BY step, area, key ORDER BY score DESC, to_size DESC, to_key) = 1),
    rooms AS (SELECT f.step, f.area, f.key, greatest(f.size - coalesce(sum(g.size), 0), 0) AS room
              FROM fresh f LEFT JOIN named n ON n.step = f.step AND n.area = f.area AND n.to_key = f.key
              LEFT JOIN gone g ON g.step = n.step AND g.area = n.area AND g.key = n.key GROUP BY f.step, f.area, f.key, f.size),
    room_spans AS (SELECT *, sum(room) OVER w AS stop, sum(room) OVER w - room AS start FROM rooms WHERE room > 0
                   WINDOW w AS (PARTITION BY step, area ORDER BY room DESC, key ROWS UNBOUNDED PRECEDING)),
    rest AS (SELECT g.step, g.area, g.key, g.size FROM gone g ANTI JOIN named n ON g.step = n.step AND g.area = n.area AND g.key = n.key),
    rest_spans AS (SELECT *, 2 * sum(size) OVER w - size AS middle FROM rest
                   WINDOW w AS (PARTITION BY step, area ORDER BY size DESC, key ROWS UNBOUNDED PRECEDING)),
    links AS (
      SELECT g.period, g.area, g.key, g.step AS to_period, n.to_key, 'name' AS method, n.score
      FROM gone g JOIN named n ON g.step = n.step AND g.area = n.area AND g.key = n.key
      UNION ALL
      SELECT g.period, g.area, g.key, g.step, r.key, 'size', 0
      FROM gone g JOIN rest_spans s ON g.step = s.step AND g.area = s.area AND g.key = s.key
      JOIN room_spans r ON r.step = s.step AND r.area = s.area AND 2 * r.start <= s.middle AND s.middle < 2 * r.stop
      UNION ALL
      SELECT u.period, u.area, u.key, p.after, u.key, 'same', 0
      FROM units u JOIN periods p USING (period) JOIN units x ON x.area = u.area AND x.key = u.key AND x.period = p.after)
"""
_LATEST_SQL = """
    walk AS (
      SELECT period, area, key, period AS at_period, key AS at_key FROM units
      UNION ALL
      SELECT w.period, w.area, w.key, l.to_period, l.to_key
      FROM walk w JOIN links l ON l.period = w.at_period AND l.area = w.area AND l.key = w.at_key),
    ends AS (SELECT period, area, key, max(at_period) AS latest_period, arg_max(at_key, at_period) AS latest_key
             FROM walk GROUP BY period, area, key),
    latest AS (SELECT *, (SELECT count(DISTINCT key) FROM ends x WHERE x.area = e.area AND x.latest_period = e.latest_period
                          AND x.latest_key = e.latest_key) AS n_merged FROM ends e)
"""


@query("merge_links", f"WITH {_LINKS_SQL} SELECT * FROM links")
def merge_links_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each unit becomes in the next period, by key, name or size."""
    return merge_links(_stored(spark, sf_dir))


@query("key_crosswalk", f"WITH RECURSIVE {_LINKS_SQL}, {_LATEST_SQL} SELECT * FROM latest")
def key_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest unit of every unit of every period, with the keys merged into it."""
    units = _stored(spark, sf_dir)
    return latest_units(units, stored_table(merge_links(units), "links"))


@query(
    "comparable_facts",
    f"""
    WITH RECURSIVE {_LINKS_SQL}, {_LATEST_SQL}
    SELECT latest_period, area, latest_key, n_merged, period, CAST(sum(size) AS BIGINT) AS size,
           CAST(sum(n_orders) AS BIGINT) AS n_orders, count(*) AS n_keys
    FROM units JOIN latest USING (period, area, key) GROUP BY ALL
    """,
)
def comparable_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods' facts on the units of the latest period they lead to."""
    units = _stored(spark, sf_dir)
    return carried_forward(units, latest_units(units, stored_table(merge_links(units), "links")), ["size", "n_orders"])

"""Grouped results. All of them aggregate partially before they shuffle, so a
key that owns a large part of the rows costs no more than any other key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from canton.functions.numbers import pct


def vote_totals(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
) -> DataFrame:
    """Sum of the metrics per key; rows with an incomplete key are left out."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(*[F.sum(m).alias(m) for m in metrics])
    )


def vote_shares(
    items: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    amount: str,
    shares: Mapping[str, tuple[str, bool]],
) -> DataFrame:
    """Attach the totals of each key to its items and add percentage shares.

    ``shares`` maps a new column to (denominator column, guarded). Both inputs
    are aggregated already; Spark measures the totals at run time and
    broadcasts them only when they are small.
    """
    joined = items.join(totals, list(keys), "left")
    return joined.withColumns(
        {
            name: pct(F.col(amount), F.col(base), guard)
            for name, (base, guard) in shares.items()
        }
    )


def first_and_sum(
    df: DataFrame,
    keys: Sequence[str],
    firsts: Sequence[str],
    sums: Sequence[str],
    order: Column | str,
) -> DataFrame:
    """Per key, the first non-null value of some columns and the sum of others.

    ``order`` says what "first" means, so the result does not depend on the
    order in which partitions arrive.
    """
    order = F.col(order) if isinstance(order, str) else order
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            *[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in firsts],
            *[F.sum(c).alias(c) for c in sums],
        )
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Column | str) -> DataFrame:
    """One row per key: the first in ``order``.

    An aggregate instead of a ranking window: copies of a key shrink to one row
    before the shuffle.
    """
    order = F.col(order) if isinstance(order, str) else order
    columns = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    kept = df.groupBy(*keys).agg(F.min_by(row, order).alias("kept"))
    return kept.select("kept.*")


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last in ``order``, other columns breaking ties."""
    columns = df.columns
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    kept = df.groupBy(*keys).agg(F.max_by(row, F.struct(*order, row)).alias("kept"))
    return kept.select("kept.*")


def winner_per_group(
    df: DataFrame,
    keys: Sequence[str],
    item: str,
    score: str,
    tie: Column | None = None,
    among: Sequence | None = None,
) -> DataFrame:
    """The item with the highest score per key.

    Equal scores are decided by the higher ``tie``, then by the greater item,
    never by row order. ``among`` restricts the candidates.
    """
    rows = df if among is None else df.where(F.col(item).isin(list(among)))
    ties = [] if tie is None else [tie.alias("tie")]
    best = F.max(F.struct(F.col(score).alias("score"), *ties, F.col(item).alias("item")))
    return (
        rows.where(F.col(score).isNotNull())
        .groupBy(*keys)
        .agg(best.alias("best"))
        .select(*keys, F.col("best.item").alias(item), F.col("best.score").alias(score))
    )


def duel_label(
    df: DataFrame, keys: Sequence[str], item: str, score: str, winner, loser, name: str
) -> DataFrame:
    """1 where ``winner`` scores strictly above ``loser``, else 0 (ties give 0).

    Keys with neither of the two have no label; a missing opponent loses.
    """
    def best(value) -> Column:
        return F.coalesce(
            F.max(F.when(F.col(item) == F.lit(value), F.col(score).cast("double"))),
            F.lit(float("-inf")),
        )

    return (
        df.where(F.col(item).isin(winner, loser))
        .groupBy(*keys)
        .agg((best(winner) > best(loser)).cast("int").alias(name))
    )


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing) for the columns with missing values, most first.

    One aggregate over one scan, turned from one wide row to long rows.
    """
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("missing"))
            for i, c in enumerate(columns)
        ]
    )
    return (
        counts.select(F.inline(pairs))
        .where("missing > 0")
        .orderBy(F.desc("missing"), "column_name")
    )


def profile(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Row count and distinct values of each column, one row per column.

    ``approximate`` uses mergeable sketches: one pass and a tiny shuffle,
    whatever the number of distinct values.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("distinct_values"))
            for i, c in enumerate(columns)
        ]
    )
    return counted.select("total_rows", F.inline(pairs))


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))


def key_drift(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of two periods with ``only_first``, ``only_second`` or ``both``.

    One grouped union: a single shuffle of keys that are reduced map-side,
    where two anti joins would shuffle both periods twice. NULL keys compare
    equal.
    """
    tagged = first.select(*keys, F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        second.select(*keys, F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    status = (
        F.when(F.col("a") > F.col("b"), "only_first")
        .when(F.col("a") < F.col("b"), "only_second")
        .otherwise("both")
    )
    return (
        tagged.groupBy(*keys)
        .agg(F.max("a").alias("a"), F.max("b").alias("b"))
        .select(*keys, status.alias("status"))
    )


def common_rows(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key also occurs in ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_semi")


def vanished_rows(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")

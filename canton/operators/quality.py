"""Data quality rules, their report and the stop on critical failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from canton.sources.literal import literal_table
from canton.sources.sinks import write_table

_ORDERED = 10_000  # distinct values that are ordered on the driver at most


@dataclass(frozen=True)
class Rule:
    """A row-level rule; ``broken`` is true for an offending row."""

    name: str
    broken: Column
    critical: bool = True


def within_percent(column: str) -> Rule:
    return Rule(f"{column}_in_0_100", ~F.col(column).between(0, 100))


def not_negative(column: str, critical: bool = False) -> Rule:
    return Rule(f"{column}_not_negative", F.col(column) < 0, critical)


def positive(column: str, critical: bool = False) -> Rule:
    return Rule(f"{column}_positive", F.col(column) <= 0, critical)


def cascade(*columns: str) -> Rule:
    """Each column is at least as large as the next one."""
    steps = [F.col(a) < F.col(b) for a, b in zip(columns, columns[1:])]
    return Rule("_ge_".join(columns), reduce(lambda a, b: a | b, steps))


def _report(
    name: Column, critical: Column, failed: Column, checked: Column
) -> list[Column]:
    return [
        name.alias("check_name"),
        critical.alias("critical"),
        checked.cast("long").alias("checked"),
        failed.cast("long").alias("failed"),
    ]


def row_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row-level rules in one scan; NULL operands break no rule."""
    counts = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *[F.count_if(r.broken).alias(f"f{i}") for i, r in enumerate(rules)],
    )
    rows = F.array(
        *[
            F.struct(*_report(F.lit(r.name), F.lit(r.critical), F.col(f"f{i}"), F.col("checked")))
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(rows))


def checked_write(df: DataFrame, path: str, rules: Sequence[Rule], **options) -> DataFrame:
    """Write ``df`` as a table and return the report of ``row_checks`` on it.

    The counts are taken by the tasks that write, so the rows are not read
    again; the report is a few literal rows.
    """
    counts = {"checked": F.count(F.lit(1))} | {f"f{i}": F.count_if(r.broken) for i, r in enumerate(rules)}
    found = write_table(df, path, metrics=counts, **options)
    rows = [(r.name, r.critical, found["checked"], found[f"f{i}"]) for i, r in enumerate(rules)]
    return literal_table(df.sparkSession, ["check_name", "critical", "checked", "failed"], rows)


def merged_reports(*reports: DataFrame) -> DataFrame:
    """Reports of the same rules on parts of a table as the report on the whole."""
    both = reduce(DataFrame.unionByName, reports)
    return both.groupBy("check_name", "critical").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"))


def unique_check(
    df: DataFrame, keys: Sequence[str], name: str, critical: bool = True
) -> DataFrame:
    """Number of keys that occur more than once."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        *_report(F.lit(name), F.lit(critical), F.count_if(F.col("n") > 1), F.coalesce(F.sum("n"), F.lit(0)))
    )


def reference_check(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], name: str, critical: bool = True
) -> DataFrame:
    """Number of fact rows whose key is not in the dimension.

    The facts are counted per key first, so a hot key joins as a single row.
    """
    counted = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(*keys).distinct().withColumn("known", F.lit(True))
    joined = counted.join(known, list(keys), "left")
    orphans = F.sum(F.when(F.col("known").isNull(), F.col("n")))
    return joined.agg(
        *_report(
            F.lit(name), F.lit(critical),
            F.coalesce(orphans, F.lit(0)), F.coalesce(F.sum("n"), F.lit(0)),
        )
    )


def ceiling_check(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    ceiling: str,
    name: str,
    critical: bool = True,
) -> DataFrame:
    """Groups whose summed ``amount`` exceeds their (repeated) ``ceiling``."""
    groups = df.groupBy(*keys).agg(F.sum(amount).alias("total"), F.max(ceiling).alias("top"))
    return groups.agg(
        *_report(
            F.lit(name), F.lit(critical),
            F.count_if(F.col("total") > F.col("top")), F.count(F.lit(1)),
        )
    )


def run_checks(
    df: DataFrame, rules: Sequence[Rule], *more: DataFrame
) -> DataFrame:
    """One report: (check_name, critical, checked, failed)."""
    return join_reports(row_checks(df, rules), *more)


def join_reports(*reports: DataFrame) -> DataFrame:
    """Reports of different rules as one."""
    return reduce(DataFrame.unionByName, reports)


class QualityError(RuntimeError):
    pass


def enforce(report: DataFrame) -> DataFrame:
    """Stop when a critical check failed; returns the report otherwise."""
    failed = report.where(F.col("critical") & (F.col("failed") > 0)).collect()
    if failed:
        raise QualityError("; ".join(f"{r.check_name}: {r.failed} of {r.checked}" for r in failed))
    return report


def fill_unknown(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace missing categories by their agreed default."""
    return df.fillna(dict(defaults))


def median_value(df: DataFrame, column: str, accuracy: int = 10_000) -> float | None:
    """Exact median without sorting the column.

    A sketch brackets the middle within a known rank error and what lies below
    is counted; the bracket is narrowed again until it holds few distinct
    values, and only these are ordered. Each pass aggregates; none moves rows.
    """
    c = F.col(column)
    n = df.agg(F.count(c)).first()[0]
    if not n:
        return None
    ranks = ((n + 1) // 2, n // 2 + 1)
    low = high = None
    while True:
        inside = df.where(c.isNotNull() if low is None else c.between(low, high))
        below = 0 if low is None else df.agg(F.count_if(c < low)).first()[0]
        held = n if low is None else inside.agg(F.count(c)).first()[0]
        values = inside.groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("n"))
        few = values.limit(_ORDERED + 1).collect()
        if len(few) <= _ORDERED:
            break
        margin = 2.0 / accuracy
        shares = [min(1.0, max(0.0, (r - below) / held + m)) for r, m in zip(ranks, (-margin, margin))]
        new = inside.agg(F.percentile_approx(c, shares, accuracy).alias("b")).first()["b"]
        if [low, high] == list(new):
            raise RuntimeError(f"the bracket of {column} does not narrow")
        low, high = new
    upto, found = below, []
    for value, count in sorted((r["v"], r["n"]) for r in few):
        upto += count
        while len(found) < 2 and upto >= ranks[len(found)]:
            found.append(value)
    return (found[0] + found[1]) / 2


def fill_median(df: DataFrame, column: str) -> DataFrame:
    """Replace missing values by the column's median."""
    middle = median_value(df, column)
    return df.withColumn(column, F.coalesce(F.col(column).cast("double"), F.lit(middle)))

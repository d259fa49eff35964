"""Mean imputation and standardisation with training statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from canton.functions.text import sql_double, sql_name


def mean_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.avg(c), F.lit(0.0))


def deviation_or_one(c: Column | str) -> Column:
    """Population deviation; 1.0 when nothing varies or nothing is known."""
    return F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0))


def column_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(pos, mean, deviation): one row per column that has rows.

    The columns of a row become one array that is exploded into a grouped
    aggregate, so the plan stays the same size for any number of columns.
    """
    values = F.array(*[F.col(sql_name(c)).cast("double") for c in columns])
    return (
        df.select(F.posexplode(values).alias("pos", "value"))
        .groupBy("pos")
        .agg(mean_or_zero("value").alias("mean"), deviation_or_one("value").alias("deviation"))
    )


@dataclass(frozen=True)
class Scaler:
    """Learned statistics: two numbers per column, whatever the row count."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    @staticmethod
    def fit(train: DataFrame, columns: Sequence[str]) -> "Scaler":
        found = {r.pos: (r.mean, r.deviation) for r in column_statistics(train, columns).collect()}
        means, deviations = zip(*[found.get(i, (0.0, 1.0)) for i in range(len(columns))])
        return Scaler(tuple(columns), means, deviations)

    def transform(self, df: DataFrame) -> DataFrame:
        """A projection: no join, no shuffle."""
        scaled = {
            c: F.expr(f"(coalesce(CAST({sql_name(c)} AS DOUBLE), {m}) - {m}) / {s}")
            for c, m, s in zip(
                self.columns, map(sql_double, self.means), map(sql_double, self.deviations)
            )
        }
        return df.withColumns(scaled)


def impute_scale(
    train: DataFrame, *others: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, ...]:
    """Scale all frames with the statistics of ``train`` alone."""
    scaler = Scaler.fit(train, columns)
    return tuple(scaler.transform(df) for df in (train, *others))

"""Column names, repeated groups, unpivot and pivot."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from canton.functions.text import strip, zfill


def stripped_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def clean_name(name: str) -> str:
    """Lower-case name with spaces, quotes and hyphens as ``_``."""
    return re.sub(r"[ '\-]", "_", name.strip().lower())


def find_column(df: DataFrame, keywords: Sequence[str]) -> str:
    """The first column whose lower-cased name holds one of the keywords."""
    for name in df.columns:
        if any(k in name.lower() for k in keywords):
            return name
    raise ValueError(f"no column matches {list(keywords)}")


def matching_columns(df: DataFrame, patterns: Sequence[str]) -> list[str]:
    return [c for c in df.columns if any(p in c for p in patterns)]


def slot_columns(common: Sequence[str], fields: Sequence[str], slots: int) -> list[str]:
    """Common names followed by ``field_1 ... field_n`` for each slot."""
    return list(common) + [f"{f}_{k}" for k in range(1, slots + 1) for f in fields]


def repair_slot_header(
    columns: Sequence[str], fields: Sequence[str], marker: str = "panneau"
) -> list[str]:
    """Name the repeated group that starts at the first ``marker`` column.

    Blank (``Unnamed: 26``) and repeated (``Voix.1``) headers are covered, as
    only positions count; what does not fill a whole slot keeps its name.
    """
    start = next((i for i, c in enumerate(columns) if marker in c.lower()), None)
    if start is None:
        return list(columns)
    slots, left = divmod(len(columns) - start, len(fields))
    tail = list(columns[len(columns) - left:]) if left else []
    return slot_columns(columns[:start], fields, slots) + tail


def rename_positional(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; names absent from ``df`` are ignored."""
    return df.withColumnsRenamed(dict(names))


def check_arity(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Impose names; a different number of columns is an error."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def slot_count(columns: Sequence[str], fields: Sequence[str]) -> int:
    """How many complete slots the schema holds."""
    present = set(columns)
    k = 0
    while all(f"{f}_{k + 1}" in present for f in fields):
        k += 1
    return k


def unpivot_slots(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str] | Mapping[str, str],
    slots: int | None = None,
) -> DataFrame:
    """One row per (row, slot) from ``field_k`` columns.

    A single scan: the slots of a row become an array that is inlined, so the
    source is not read once per slot. ``fields`` may map source to output name.
    """
    names = dict(fields) if isinstance(fields, Mapping) else {f: f for f in fields}
    n = slots or slot_count(df.columns, list(names))
    if n == 0:
        raise ValueError("the frame has no complete slot")
    rows = [
        F.struct(*[F.col(f"`{src}_{k}`").alias(out) for src, out in names.items()])
        for k in range(1, n + 1)
    ]
    return df.select(*[F.col(f"`{k}`") for k in keys], F.inline(F.array(*rows)))


def column_values(df: DataFrame, *columns: str) -> list:
    """Sorted distinct non-null values that are to become columns.

    Column names are part of a plan, so they are gathered on the driver. For
    more values than a table should have columns use a long form, such as
    ``long_sum``, which needs none of them.
    """
    rows = df.select(*columns).dropna().distinct().collect()
    return sorted(r[0] if len(columns) == 1 else tuple(r) for r in rows)


def long_sum(
    df: DataFrame, index: Sequence[str], column: str, value: str, blank_as_zero: bool = False
) -> DataFrame:
    """The pivot in long form: one summed row per index and value, any number of values."""
    amount = F.coalesce(F.col(value), F.lit(0)) if blank_as_zero else F.col(value)
    return df.dropna(subset=[*index, column]).groupBy(*index, column).agg(F.sum(amount).alias(value))


def pivot_sum(
    df: DataFrame,
    index: Sequence[str],
    column: str,
    value: str,
    values: Sequence | None = None,
    blank_as_zero: bool = False,
) -> DataFrame:
    """One row per index, one summed column per pivot value.

    Conditional sums need a single shuffle of partially aggregated rows, where
    the pivot operator needs two. Rows with a NULL index are dropped; a pair
    that never occurs is NULL. ``blank_as_zero`` counts a NULL value as 0, so a
    pair with only blank values gives 0. Without ``values`` all values of the
    data become columns.
    """
    if values is None:
        values = column_values(df, column)
    amount = F.coalesce(F.col(value), F.lit(0)) if blank_as_zero else F.col(value)
    sums = [
        F.sum(F.when(F.col(column) == F.lit(v), amount)).alias(clean_name(str(v)))
        for v in values
    ]
    return (
        df.dropna(subset=list(index))
        .groupBy(*index)
        .agg(*sums)
        .withColumnsRenamed({c: clean_name(c) for c in index})
    )


def filter_area(
    df: DataFrame, column: str, code: str, width: int = 2, conform: bool = True
) -> DataFrame:
    """Rows of one area, with the canonical code in ``column``.

    Zeros are dropped before padding, so ``69``, `` 69`` and ``069`` agree and
    group together afterwards. ``conform=False`` compares as is, which a
    Parquet scan can push down.
    """
    value = F.col(f"`{column}`")
    if not conform:
        return df.where(value == code)
    return df.withColumn(column, conform_area(value, width)).where(value == code)


def conform_area(c: Column, width: int = 2) -> Column:
    return zfill(F.ltrim(strip(c), F.lit("0")), width)

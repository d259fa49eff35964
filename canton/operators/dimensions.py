"""Dimension tables: distinct members, sequential keys and key lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from canton.functions.keys import numbered_id
from canton.session import broadcast_if_small, durable

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id: row number inside its partition


def members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def numbered(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number the rows 1..n in the order of ``keys`` without a single-task sort.

    The rows are range-partitioned and sorted in parallel and stored, so a lost
    executor cannot change the ranges. Each partition then starts after the
    rows of the partitions before it; only one row per partition is summed.
    ``keys`` must identify the rows.
    """
    order = [F.asc_nulls_first(k) for k in keys]
    local = durable(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                "part_no": F.spark_partition_id(),
                "row_no": F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)),
            }
        )
    )
    sizes = local.groupBy("part_no").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "part_no", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")
    )
    # One row per partition of the sort: bounded by the partition count.
    return local.join(F.broadcast(starts), "part_no").select(
        *df.columns, (F.col("start") + F.col("row_no") + 1).alias(name)
    )


def surrogate_key(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    prefix: str = "",
    width: int = 3,
) -> DataFrame:
    """Members of ``keys`` with ``prefix001``-style ids in natural key order.

    The order is the data's own, so a rerun yields the same ids.
    """
    dim = numbered(members(df, keys), keys, "number")
    return dim.select(numbered_id(F.col("number"), prefix, width).alias(name), *keys)


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    null_safe: bool = True,
    how: str = "left",
) -> DataFrame:
    """Attach the other columns of ``dim`` to ``fact``.

    ``null_safe`` lets a NULL key part match NULL. Pass a stored ``dim``: its
    rows are counted (file metadata), and a small one is broadcast, so that the
    facts are never dealt out by a key of a few values. A larger one is joined
    by sort-merge, where adaptive execution splits a hot key on the fact side.
    """
    right = broadcast_if_small(dim).select([F.col(c).alias(f"dim__{c}") for c in dim.columns])

    def same(k: str) -> Column:
        a, b = fact[k], right[f"dim__{k}"]
        return a.eqNullSafe(b) if null_safe else a == b

    condition = same(keys[0])
    for k in keys[1:]:
        condition = condition & same(k)
    added = [c for c in dim.columns if c not in keys]
    return fact.join(right, condition, how).select(
        *[fact[c] for c in fact.columns], *[right[f"dim__{c}"].alias(c) for c in added]
    )


def required(c: Column, message: str) -> Column:
    """The value itself; a NULL fails the job (an unknown key is an error)."""
    return F.when(c.isNotNull(), c).otherwise(F.raise_error(F.lit(message)))


def require_key(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], check: str
) -> DataFrame:
    """Lookup in which every fact row must find its member.

    ``check`` is a never-null column of ``dim``. Evaluated in the same pass as
    the join: no extra job looks for orphans first.
    """
    joined = lookup_key(fact, dim, keys, null_safe=False)
    return joined.withColumn(check, required(F.col(check), f"unknown {'/'.join(keys)}"))

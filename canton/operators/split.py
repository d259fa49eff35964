"""Stratified train/test split with exact sizes per class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from canton.functions.text import sql_name
from canton.session import broadcast_if_small, stored_table

# 16^5 buckets per class: a bucket holds about a millionth of its class.
_BUCKET_DIGITS = 5


def shuffle_hash(id_column: str, seed: int) -> Column:
    """Reproducible pseudo-random order of the rows: ``md5(seed:id)``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def class_cuts(
    df: DataFrame, label: str, id_column: str, test: float = 0.2, seed: int = 42
) -> DataFrame:
    """(y, cut): per class, the last hash of its training part.

    The first ``max(1, round(n * (1 - test)))`` rows of a class in hash order
    train. A class can hold most of the table, so none is sorted: its rows are
    counted per hash bucket, and only the bucket with the cut is ranked. The
    cuts are a table of one row per class, however many classes there are.
    """
    rows = df.select(F.col(label).alias("y"), shuffle_hash(id_column, seed).alias("h")).where("y IS NOT NULL")
    bucket = F.substring("h", 1, _BUCKET_DIGITS)
    buckets = rows.groupBy("y", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    by_class = Window.partitionBy("y")
    so_far = by_class.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.greatest(F.lit(1), F.rint(F.sum("n").over(by_class) * (1 - test)).cast("long"))
    cuts = stored_table(
        buckets.withColumns({"upto": F.sum("n").over(so_far), "wanted": wanted})
        .where("upto >= wanted AND upto - n < wanted")
        .select("y", "bucket", (F.col("wanted") - F.col("upto") + F.col("n")).alias("take")),
        "cuts",
    )
    inside = rows.withColumn("bucket", bucket).join(broadcast_if_small(cuts), ["y", "bucket"])
    place = F.row_number().over(Window.partitionBy("y").orderBy("h"))
    last = inside.withColumn("place", place).where(F.col("place") == F.col("take"))
    return stored_table(last.select("y", F.col("h").alias("cut")), "cuts")


def split_by(
    df: DataFrame, cuts: DataFrame, label: str, id_column: str, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of ``df`` by known cuts; a small cut table is broadcast."""
    right = broadcast_if_small(cuts.select(F.col("y").alias("cut__y"), F.col("cut").alias("cut__h")))
    joined = df.join(right, F.col(f"`{label}`") == F.col("cut__y"))
    is_train = shuffle_hash(id_column, seed) <= F.col("cut__h")
    parts = (joined.where(is_train), joined.where(~is_train))
    kept = [sql_name(c) for c in df.columns]
    return parts[0].select(kept), parts[1].select(kept)


def stratified_split(
    df: DataFrame, label: str, id_column: str, test: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test): two filters over ``df``.

    ``id_column`` must be unique; rows without a label are in neither part.
    """
    return split_by(df, class_cuts(df, label, id_column, test, seed), label, id_column, seed)

"""Sparse feature vectors from long (key, feature, value) rows.

Names stay data: they are numbered in a stored dictionary and never become
columns or reach the driver, so a plan has the same size for ten features and
for ten million. A value that is absent stands for the training mean; scaled,
that is exactly zero, which is what a sparse vector leaves out.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from canton.operators.dimensions import numbered
from canton.operators.scaling import deviation_or_one, mean_or_zero
from canton.session import broadcast_if_small, scratch_path, stored_table


def feature_dictionary(rows: DataFrame, train: Column | None = None) -> DataFrame:
    """(feature, index, n_rows, mean, deviation): one stored row per feature name.

    Indices run from 0 in the order of the names. The statistics are those of
    the values of ``train`` rows (all rows when absent): the mean of what is
    known, or 0, and the population deviation, or 1 where nothing varies.
    NULL values count as absent, rows without a name are left out.
    """
    value = F.col("value") if train is None else F.when(train, F.col("value"))
    stats = (
        rows.where(F.col("feature").isNotNull())
        .groupBy("feature")
        .agg(
            F.count(value).alias("n_rows"),
            mean_or_zero(value).alias("mean"),
            deviation_or_one(value).alias("deviation"),
        )
    )
    order = numbered(stats, ["feature"], "number")
    return stored_table(
        order.select("feature", (F.col("number") - 1).cast("int").alias("index"), "n_rows", "mean", "deviation"),
        "features",
    )


def scaled_entries(rows: DataFrame, dictionary: DataFrame, *keys: str) -> DataFrame:
    """(keys, index, value): the scaled values of the features in ``dictionary``.

    A dictionary of bounded size is broadcast; a larger one is joined by name,
    where adaptive execution splits a name that most rows hold.
    """
    joined = rows.where(F.col("value").isNotNull()).join(broadcast_if_small(dictionary), "feature")
    return joined.select(*keys, "index", ((F.col("value") - F.col("mean")) / F.col("deviation")).alias("value"))


def sparse_vectors(entries: DataFrame, key: str) -> DataFrame:
    """(key, indices, values): each key's entries by rising index, one per feature.

    Entries must be unique by key and index. A group is one vector, not larger
    than the dictionary.
    """
    listed = F.sort_array(F.collect_list(F.struct("index", "value")))
    return (
        entries.groupBy(key)
        .agg(listed.alias("entries"))
        .select(key, F.col("entries.index").alias("indices"), F.col("entries.value").alias("values"))
    )


def with_vectors(rows: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """``rows`` with the vectors of their key; an empty vector where there is none."""
    joined = rows.join(vectors, key, "left")
    return joined.withColumns(
        {
            "indices": F.coalesce("indices", F.array().cast("array<int>")),
            "values": F.coalesce("values", F.array().cast("array<double>")),
        }
    )


def ml_vectors(df: DataFrame, size: int, *keep: str, name: str = "features") -> DataFrame:
    """``indices`` and ``values`` as a column of ML vectors, beside the ``keep`` columns.

    Written with the vector type's own layout and read back as that type: rows
    never pass through Python.
    """
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"), "indices", "values"
    ).alias(name)
    plain = df.select(*keep, vector)
    path = scratch_path(df.sparkSession, "ml-vectors")
    plain.write.parquet(path)
    fields = [plain.schema[c] for c in keep] + [StructField(name, VectorUDT(), True)]
    return df.sparkSession.read.schema(StructType(fields)).parquet(path)


def sparse_scores(entries: DataFrame, weights: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name): the sum of value times weight over a key's entries.

    ``weights`` has one row (index, weight) per feature; entries of other
    features count nothing.
    """
    joined = entries.join(broadcast_if_small(weights), "index")
    return joined.groupBy(key).agg(F.sum(F.col("value") * F.col("weight")).alias(name))

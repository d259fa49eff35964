"""Audit columns, tables and text exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from canton.functions.times import iso_text


def with_audit(
    df: DataFrame,
    source_url: str,
    ingested_at: str | None = None,
    file_name: Column | None = None,
) -> DataFrame:
    """Add where the rows came from, when, and from which file.

    ``df`` must stem from a file scan unless ``file_name`` is given. A fixed
    ``ingested_at`` makes a rerun reproducible.
    """
    stamp = F.lit(ingested_at) if ingested_at else iso_text(F.current_timestamp(), micros=True)
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.lit(source_url).alias("extraction_source_url"),
        stamp.alias("ingestion_timestamp"),
        (F.col("_metadata.file_name") if file_name is None else file_name).alias("source_file_name"),
    )


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    metrics: Mapping[str, Column] | None = None,
    only_present: bool = False,
) -> dict[str, object]:
    """Parquet table, replaced as a whole; returns ``metrics`` of the rows written.

    A partitioned write is rebalanced first: each task then holds few partition
    values (no small-file explosion), and adaptive execution splits a
    partition value that is too big for one task. ``metrics`` are aggregates
    that the writing tasks collect on the way, after every shuffle: a task that
    is run again counts once. ``only_present`` replaces the partitions that
    ``df`` has rows for and leaves the others alone.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    watch = Observation() if metrics else None
    if watch:
        df = df.observe(watch, *[value.alias(name) for name, value in metrics.items()])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if only_present:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return dict(watch.get) if watch else {}


def read_table(spark: SparkSession, path: str | Sequence[str], schema=None) -> DataFrame:
    """One table, or several folders of the same layout stacked by one scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def export_csv(
    df: DataFrame, path: str, sep: str = ";", columns: Sequence[str] | None = None
) -> None:
    """UTF-8 text with a header per part file; values are written untrimmed."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").options(
        sep=sep, header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    ).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line; absent values stay visible as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)

"""Delimited text sources. Everything is read as text with a fixed schema:
schema inference costs a second pass and destroys zero-padded codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from canton.operators.shaping import slot_columns

# Rule: the cp1252 characters of bytes 0x80-0x9F; ISO-8859-1 reads those bytes
# as the control characters with the same code points.
_C1 = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_C1_FROM = "".join(map(chr, _C1))
_C1_TO = bytes(_C1).decode("cp1252")


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def restore_cp1252(c: Column) -> Column:
    """Text that was read as ISO-8859-1 back to the cp1252 text it stands for."""
    return F.translate(c, _C1_FROM, _C1_TO)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | T.StructType | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    header: bool = True,
    missing: Sequence[str] = (),
) -> DataFrame:
    """All-text read of one file, a glob or a list of paths.

    With ``columns`` the names are imposed and ``header`` only says whether the
    first line of each file is skipped; without it names come from the header.
    A ``StructType`` imposes types as well: no value is inferred, and a value
    that its type cannot hold fails the job.
    A byte-order mark is dropped. ``missing`` lists extra spellings of "no value".
    ``encoding="cp1252"``, which the reader does not know, is read as
    ISO-8859-1 and mapped back exactly.
    """
    as_latin = encoding.lower() in ("cp1252", "windows-1252")
    reader = spark.read.options(
        sep=sep,
        header=header,
        encoding="ISO-8859-1" if as_latin else encoding,
        quote='"',
        escape='"',
        mode="PERMISSIVE",
        inferSchema=False,
    )
    if isinstance(columns, T.StructType):
        reader = reader.schema(columns).option("mode", "FAILFAST")
    elif columns is not None:
        reader = reader.schema(text_schema(columns))
    df = reader.csv(path)
    if not (as_latin or missing):
        return df

    types = dict(df.dtypes)

    def cleaned(name: str) -> Column:
        value = F.col(f"`{name}`")
        if as_latin and types[name] == "string":
            value = restore_cp1252(value)
        if missing and types[name] == "string":
            value = F.when(~value.isin(*missing), value)
        return value.alias(restored(name) if as_latin else name)

    def restored(name: str) -> str:
        return name.translate(str.maketrans(_C1_FROM, _C1_TO))

    return df.select(*map(cleaned, df.columns))


def read_wide_votes(
    spark: SparkSession,
    path: str | list[str],
    common: Sequence[str],
    fields: Sequence[str],
    slots: int,
    sep: str = ";",
    encoding: str = "cp1252",
    header: bool = True,
) -> DataFrame:
    """Wide result file whose header does not name its repeated columns.

    Lines that carry fewer slots are padded with NULL. ``header=False`` keeps
    the first line as data; the area filter then removes it.
    """
    return read_delimited(
        spark, path, slot_columns(common, fields, slots), sep, encoding, header
    )


def sniff_delimiter(
    spark: SparkSession,
    path: str,
    candidates: Sequence[str] = (";", ",", "\t", "|"),
) -> str:
    """The separator that occurs most often in the head line of every file.

    One aggregate by file finds the head lines. Files of a glob that differ in
    their separator cannot be read together: that raises, as does a file
    without any candidate.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
    )
    counts = [
        F.struct(
            F.size(F.split(F.col("head"), "\\" + sep if sep == "|" else sep)) - 1,
            F.lit(-i), F.lit(sep).alias("sep"),
        )
        for i, sep in enumerate(candidates)
    ]
    best = F.array_max(F.array(*counts))
    found = (
        lines.groupBy("file").agg(F.min_by("value", "place").alias("head"))
        .select(F.when(best["col1"] > 0, best["sep"]).alias("sep"), "file")
        .groupBy("sep").agg(F.min("file").alias("file"))
        .collect()  # a row per separator
    )
    if not found or any(r["sep"] is None for r in found):
        raise ValueError(f"no known separator in the head of {found[0]['file'] if found else path}")
    if len(found) > 1:
        raise ValueError("files with different separators: " + ", ".join(sorted(r["file"] for r in found)))
    return found[0]["sep"]


def file_order() -> Column:
    """Position of a row in its source files; use directly on a file scan."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )

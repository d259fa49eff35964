"""Reloads that leave each landed file's rows exactly once.

A ledger lists what was loaded: per unit (a file, or a folder of part files) a
fingerprint of its files. A unit whose fingerprint is not the ledger's is read,
and its partition of the table is replaced; the others are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from canton.session import stored_table
from canton.sources.sinks import read_table, write_table

UNIT = "landed_unit"
_MARK = "landed_mark"  # true for the row that stands for a unit, so that one without rows replaces its partition too
_LEDGER = "unit string, fingerprint string, n_files long, n_bytes long, n_rows long, load_no long"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


@dataclass(frozen=True)
class Ledger:
    """A table at ``path`` and the ledger of what it holds beside it.

    ``unit`` derives a unit from a file's path: ``file_name`` for single files,
    ``folder_name`` for folders of part files that are corrected together.
    """

    path: str
    unit: Callable[[Column], Column] = file_name

    def _entries(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.schema(_LEDGER).parquet(f"{self.path}/ledger")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], _LEDGER)  # nothing was loaded yet

    def loaded(self, spark: SparkSession) -> DataFrame:
        """The last entry of each unit."""
        last = F.max_by(F.struct("*"), "load_no").alias("last")
        return self._entries(spark).groupBy("unit").agg(last).select("last.*")

    def landed(self, spark: SparkSession, files: str | list[str]) -> DataFrame:
        """unit, fingerprint, n_files, n_bytes and paths of what lies there. No file is opened."""
        listed = spark.read.format("binaryFile").load(files).select("path", "modificationTime", "length")
        state = F.concat_ws("|", "path", F.unix_micros("modificationTime"), "length")
        return listed.groupBy(self.unit(F.col("path")).alias("unit")).agg(
            F.sha2(F.concat_ws("\n", F.sort_array(F.collect_list(state))), 256).alias("fingerprint"),
            F.count(F.lit(1)).alias("n_files"),
            F.sum("length").alias("n_bytes"),
            F.collect_list("path").alias("paths"),
        )

    def pending(self, spark: SparkSession, files: str | list[str]) -> DataFrame:
        """What landed and is new or changed."""
        known = self.loaded(spark).select("unit", "fingerprint")
        return self.landed(spark, files).join(known, ["unit", "fingerprint"], "left_anti")

    def load(self, spark: SparkSession, files: str | list[str], read: Callable[[list[str]], DataFrame]) -> int:
        """Load what is pending; returns the number of units that were replaced.

        ``read`` makes a frame of the paths it is given; the rows' unit comes
        from the file each row was read from, so the frame must stem from a
        file scan. A run that stops after the table and before the ledger is
        written only repeats itself. The paths of pending files pass the driver.
        """
        pending = stored_table(self.pending(spark, files), "pending")
        paths = sorted(p for r in pending.select("paths").collect() for p in r["paths"])
        if not paths:
            return 0
        rows = read(paths)
        tagged = rows.select(
            *[F.col(f"`{c}`") for c in rows.columns],
            F.lit(False).alias(_MARK),
            self.unit(F.col("_metadata.file_path")).alias(UNIT),
        )
        marks = pending.select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema], F.lit(True).alias(_MARK), F.col("unit").alias(UNIT)
        )
        write_table(tagged.unionByName(marks), f"{self.path}/rows", [UNIT], only_present=True)
        counted = self._stored(spark).where(~F.col(_MARK)).groupBy(F.col(UNIT).alias("unit")).agg(F.count(F.lit(1)).alias("n_rows"))
        number = (self._entries(spark).agg(F.max("load_no")).first()[0] or 0) + 1
        entries = pending.join(counted, "unit", "left").select(
            "unit", "fingerprint", "n_files", "n_bytes",
            F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.lit(number).cast("long").alias("load_no"),
        )
        count = pending.count()
        entries.coalesce(1).write.mode("append").parquet(f"{self.path}/ledger")
        return count

    def _stored(self, spark: SparkSession) -> DataFrame:
        # The unit is a partition of the path; it is text whatever it looks like.
        plain = read_table(spark, f"{self.path}/rows")
        fields = [f for f in plain.schema.fields if f.name != UNIT]
        return read_table(spark, f"{self.path}/rows", type(plain.schema)(fields).add(UNIT, "string"))

    def table(self, spark: SparkSession) -> DataFrame:
        """All rows of the units loaded so far, with ``landed_unit``."""
        return self._stored(spark).where(~F.col(_MARK)).drop(_MARK)

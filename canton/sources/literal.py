from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """A small reference table stated in code.

    Built from Arrow it is a local relation whose size the optimizer knows, so
    a join with it is broadcast without a hint.
    """
    values = zip(*rows, strict=True)
    return spark.createDataFrame(pa.table(dict(zip(columns, map(pa.array, map(list, values)), strict=True))))

"""Session set-up and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_ROWS = 200_000  # of a dimension: some tens of MB at most


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("canton")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call sites for error messages triple the cost of building wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="canton-"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``, else one in the warehouse.

    Both are places that all executors see, whatever the master is; a
    machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir"
    )
    folder = configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/canton-scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later scans read the columns they need, and Spark knows the table's size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(stored: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table, marked for broadcast if it is counted to have ``most`` rows at most."""
    return F.broadcast(stored) if stored.limit(most + 1).count() <= most else stored


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once onto reliable storage and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

"""Settings read from the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECKPOINT_DIR = "spark.checkpoint.dir"
SPREAD_ROWS = 25_000  # at most, on average, in a partition that ``spread`` makes


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh temporary one only in local mode."""
    configured = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_DIR
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{_CHECKPOINT_DIR} must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="veilrank-")
    spark.conf.set(_CHECKPOINT_DIR, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result once and read it back, so that several consumers share one computation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that this library wrote, wherever they are."""
    jvm = spark._jvm
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def with_row_key(df: DataFrame, key: str, path: str) -> DataFrame:
    """The table with a unique key, written to ``path`` once and read from there.

    Keys are numbered by partition and row, so they are unique also among equal rows.  The
    written table is what makes them repeatable: read it again instead of making them anew.
    """
    df.withColumn(key, F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a small input over the cores before costly text work.

    The bytes that the plan expects to read tell how many splits a scan has; from one split for
    every core on, rows stay where they are, however few files they are in.  Those bytes are packed, and texts
    that repeat pack very small, so the partitions follow the rows, which a Parquet table's footers tell: a
    task's share does not grow with the table.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    if size >= cores * split:
        return df
    return df.repartition(max(cores, -(-df.count() // SPREAD_ROWS)), *keys)

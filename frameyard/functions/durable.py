"""Durable cuts of lineage in the folder that all executors share, and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that may be broadcast when a row holds only a few numbers (about 16 MB).
BROADCAST_ROWS = 400_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Where the session names none, one of our own on a single machine; on a cluster
    that is an error, for a local folder would be another one on each executor."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (found or "/tmp/checkpoints").rstrip("/")


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def materialize(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: later steps never recompute it, whichever
    executor is lost. The files go when the session ends, or earlier by release()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/frameyard-{uuid.uuid4().hex}"
    (df.coalesce(parts) if parts else df).write.parquet(path)
    fs, p = _fs_path(spark, path)
    fs.deleteOnExit(p)
    out = spark.read.schema(df.schema).parquet(path)
    out._frameyard_path = path
    return out


def settled(df: DataFrame) -> DataFrame:
    """df with its columns computed once a row. Spark merges a projection into the one above it and so repeats an
    expression wherever it is used; over a dozen steps that grows without bound. A generator of one row keeps them apart,
    without a shuffle or a write."""
    return df.select(F.explode(F.array(F.struct("*"))).alias("_row")).select("_row.*")


def release(df: DataFrame) -> None:
    """Delete a materialized table that no later step reads."""
    if path := getattr(df, "_frameyard_path", None):
        fs, p = _fs_path(df.sparkSession, path)
        fs.delete(p, True)


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, counted: int | None = None) -> DataFrame:
    """Hint a broadcast only if df (materialized, so that counting is cheap) has few rows; else Spark's own joins."""
    n = df.count() if counted is None else counted
    return F.broadcast(df) if n <= rows else df

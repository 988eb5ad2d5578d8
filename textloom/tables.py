"""Intermediate tables in the folder that driver and executors share, and joins that spare hot keys."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset a local master gets a temporary one, and a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='textloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it again: lineage ends there, and a lost executor costs nothing. The files go when the driver's JVM ends, or by drop_written(). What written() gave is written already and stays as it is."""
    if hasattr(df, "_textloom_path"):
        return df
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textloom/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._textloom_path = path
    return out


def drop_written(*tables: DataFrame) -> None:
    """Deletes tables made by written() that no later plan reads."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs.Path(df._textloom_path)
        hadoop.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m"):
    """What runs within it hands Python about `size` of rows at once (a longer row by itself) instead of 64 MB, which the JVM and the worker hold several times. A size that the session has set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.unset(key)


def join_hot(big: DataFrame, small: DataFrame, on: list[str], total: int, n: str = "n", parts: int = 200, how: str = "inner") -> DataFrame:
    """big joined with small (inner or left), which has one row a key and in n how many of big's `total` rows have it. The keys of more than total / parts rows, fewer than `parts` of them, are broadcast, so that a hot key's rows stay where they are; the others are shuffled without these."""
    limit = total / parts
    hot, rest = F.broadcast(small.where(F.col(n) > limit)), small.where(F.col(n) <= limit)
    return big.join(hot, on).unionByName(big.join(hot.select(*on), on, "left_anti").join(rest, on, how))


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions at least as the session has cores: else a small input in one file would be one task. An input that comes in enough partitions stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores else df.repartition(cores)

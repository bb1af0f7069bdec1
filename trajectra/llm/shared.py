"""What several operators of this subpackage need: tables, cut lineage, the shared folder."""

from __future__ import annotations

import gc
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from trajectra.batches import BATCH_BYTES, small_batches  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode, if unset, one made here."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="trajectra-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written reliably to the shared folder, without their lineage."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    out = df.checkpoint()
    release(spark)
    return out


def apart(df: DataFrame) -> DataFrame:
    """The same rows, whose expressions aren't merged into those of later projections.

    Spark can't hand an argument of three nested lambdas to a Python function; to coalesce into more partitions than
    there are changes nothing, but keeps such an expression in a projection of its own.
    """
    return df.coalesce(1 << 30)


_released = [0.0]


def release(spark: SparkSession, every: float = 4.0) -> None:
    """Let Spark drop the shuffle files and blocks behind lineage that was cut, at most every few seconds.

    It drops them when the driver's JVM collects the objects that stand for them; on its own it
    does so every half hour, and meanwhile a job of many rounds fills disks with dead files.
    """
    if time.monotonic() - _released[0] >= every:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _released[0] = time.monotonic()

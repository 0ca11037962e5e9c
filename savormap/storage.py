"""Shared scratch space: checkpoints, written tables and stream state."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="savormap-")
    context.setCheckpointDir(root)
    return root


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared root."""
    path = f"{shared_root(spark)}/savormap/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove_stored(df: DataFrame) -> None:
    """Remove a table that ``cut_lineage`` has stored and nothing reads any more.

    What was shuffled to make it goes too, as soon as the driver collects its garbage.
    """
    spark, files = df.sparkSession, df.inputFiles()
    if files:
        target = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage, whereupon executors drop shuffles of steps that are stored."""
    gc.collect()
    spark._jvm.System.gc()


def remove_scratch(spark: SparkSession) -> None:
    """Remove the scratch paths this process has made; for the end of a job, when nothing reads them."""
    while _made:
        target = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Store the rows as a table in the shared folder and read them from there.

    Later stages then neither recompute them nor depend on the executors that
    made them, read only the columns they need, and know the table's size.
    ``compression`` names another codec than the session's.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SMALL_BYTES = 256 * 1024 * 1024


def spread_if_small(df: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """Use every core on a small table that sits in one row group.

    For work that is heavy per row. Above ``limit`` (by the optimizer's own
    estimate) the scan has splits enough and nothing is shuffled.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if size <= limit else df

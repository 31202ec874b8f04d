"""Shared working storage for intermediate tables."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side, in bytes of text, that is copied to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# Largest table, in bytes of its files, that is shuffled only to use more cores.
SPREAD_BYTES = 1024 * 1024 * 1024


def shared_root(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`. A temporary folder is used in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagemill-"))
    return spark.sparkContext.getCheckpointDir()


# Folders that go when their application ends.
_OWNED: set[str] = set()


def work_root(spark: SparkSession) -> str:
    """The application's own folder below the shared one. It is deleted when the application ends."""
    context = spark.sparkContext
    root = f"{shared_root(spark)}/pagemill/{context.applicationId}"
    if root not in _OWNED:
        folder = context._jvm.org.apache.hadoop.fs.Path(root)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _OWNED.add(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's folder; nothing is created there yet."""
    return f"{work_root(spark)}/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    This cuts the lineage, survives lost executors, and gives later joins the measured size.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_sized(df: DataFrame, name: str, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Stage `df`, and say whether its measured size is within `limit` and thus fit for broadcast."""
    staged = stage(df, name)
    size = F.lit(16)
    for column in staged.columns:
        size = size + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    return staged, (staged.agg(F.sum(size)).first()[0] or 0) <= limit


def planned_bytes(df: DataFrame) -> int:
    """The planner's bound for the bytes of `df`; of a plain scan the size of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def surely_larger(df: DataFrame, limit: int) -> bool:
    """Whether the distinct rows of `df` hold far more than `limit` bytes of text; nothing is written.

    The planner's own bound decides where it is within the limit. Else one pass counts distinct rows
    by a sketch and takes their mean size.
    """
    if planned_bytes(df) <= limit:
        return False
    size = F.lit(16)
    for column in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(column).cast("string")), F.lit(0))
    count, mean = df.agg(F.approx_count_distinct(F.struct(*df.columns)), F.avg(size)).first()
    return count * (mean or 0) > 2 * limit


def spread_few_splits(table: DataFrame, tasks: int | None = None) -> DataFrame:
    """Spread a table that is read in fewer splits than there are cores, before costly row work.

    For a plain scan, such as one small file of large pages. A table with enough splits, or of more
    than SPREAD_BYTES, is returned as it is, without a shuffle.
    """
    tasks = tasks or table.sparkSession.sparkContext.defaultParallelism
    if planned_bytes(table) > SPREAD_BYTES:
        return table
    return table.repartition(tasks) if table.rdd.getNumPartitions() < tasks else table

"""Session defaults and the shared work area."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Joins on patient or code may meet one key with a third of the rows; adaptive execution splits
# such partitions, also where that costs another exchange further up.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Where every partition of the small side is at most this large, hash it and do not sort the
    # large side. Compressed size: a task holds a few times as much.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Few output partitions per task: write them side by side instead of sorting first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.session.timeZone": "UTC",
}


_MB = 1 << 20


def sized(input_bytes: int, task_bytes: int = 256 * _MB) -> dict[str, str]:
    """Task sizes for a job over ``input_bytes``: some ``task_bytes`` for each scan task and shuffle
    partition, which a task can sort in memory. Adaptive execution merges partitions that turn out
    small but never adds any, so they must grow with the input.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // task_bytes))),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
    }


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of the files below ``paths``; patterns and missing paths count as nothing. Totals come
    from the file system, no file name reaches the driver's Python."""
    conf, total = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(conf)
        if system.exists(folder):
            total += system.getContentSummary(folder).getLength()
    return total


def build_session(
    app_name: str = "chartloom", input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with these settings, task sizes by ``input_bytes`` if given, and ``extra``."""
    builder = SparkSession.builder.appName(app_name)
    sizes = sized(input_bytes) if input_bytes is not None else {}
    for key, value in {**SETTINGS, **sizes, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="chartloom-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_area: ContextVar[str] = ContextVar("area", default="kept")


def _area_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/chartloom/{spark.conf.get('spark.app.id', 'app')}/{_area.get()}"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, never used before."""
    return f"{_area_path(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def work_area(spark: SparkSession) -> Iterator[None]:
    """Remove what is stored in between at the end of the block.

    What the block is for must be written elsewhere by then. Without a block, stored results stay,
    as frames may read them as long as the application runs.
    """
    outer = _area.set(uuid.uuid4().hex)
    path = _area_path(spark)
    try:
        yield
    finally:
        _area.reset(outer)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the stored table.

    Cuts the lineage, survives lost executors, fixes the values of non-deterministic columns and
    gives the planner exact sizes, so that it broadcasts a side only when it is small enough.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

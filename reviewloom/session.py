"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import logging
import math
import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession

log = logging.getLogger(__name__)

# Times are written as UTC; skewed joins may be split even where a later
# grouping then needs one more shuffle; call sites are not sent to the JVM with
# every column expression, which takes most of the time of building a plan.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# A shuffle partition of this size sorts in memory on a core's share of an executor.
PARTITION_BYTES = 128 * 1024 * 1024


def configure(
    builder: SparkSession.Builder, largest_shuffle: int | None = None
) -> SparkSession.Builder:
    """Apply the settings. ``largest_shuffle`` is the expected size in bytes of the
    largest shuffle, mostly one day's snapshot; small ones are coalesced at run time."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if largest_shuffle is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(max(1, math.ceil(largest_shuffle / PARTITION_BYTES))),
        )
    return builder


def size_shuffles(spark: SparkSession, largest_shuffle: int) -> None:
    """Shuffle partitions for a shuffle of so many bytes, for the queries that follow. Never
    fewer than configured; small ones are coalesced at run time."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = max(least, math.ceil(largest_shuffle / PARTITION_BYTES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number))


# Folders made within each open ``removed_scratch``, innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def removed_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made within are removed at the end, whether it failed or not.

    Frames that read them must not be used after.
    """
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.remove(made)
        for folder in made:
            _remove(spark, folder)


def _remove(spark: SparkSession, folder: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:
        log.exception("the scratch folder %s could not be removed", folder)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name below a folder that all executors share.

    That is ``spark.checkpoint.dir``, else the warehouse folder. A cluster session
    without either is refused: the default warehouse folder is local to the driver.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.conf.get("spark.sql.warehouse.dir", None)
        local = spark.sparkContext.master.startswith("local")
        if shared is None or not local and shared.startswith("file:"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = posixpath.join(shared, f"reviewloom-{uuid.uuid4().hex}")
    if _SCOPES:
        _SCOPES[-1].append(folder)
    return folder


# Codec of scratch tables that hold whole texts: two thirds of the bytes of the default one.
COMPACT = "zstd"


def store(
    frame: DataFrame, folder: str | None = None, compression: str | None = None
) -> DataFrame:
    """Write ``frame`` to the scratch folder once and go on from the written table.

    Later steps read the files, so neither several uses nor a lost executor
    recomputes what came before.
    """
    spark = frame.sparkSession
    path = folder or scratch_folder(spark)
    frame.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def store_counted(
    frame: DataFrame, *counters, compression: str | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """``store``, and the values of ``counters`` (aggregates with a name) over the rows,
    gathered while they are written."""
    seen = Observation()
    stored = store(frame.observe(seen, *counters), compression=compression)
    return stored, dict(seen.get)

"""Task records of Spark's own event log (public JSON format, one event per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TASK_SCHEMA = """
    `Event` string,
    `Stage ID` bigint,
    `Stage Attempt ID` int,
    `Task Info` struct<
        `Launch Time`: bigint,
        `Finish Time`: bigint>,
    `Task Metrics` struct<
        `Executor Run Time`: bigint,
        `Executor CPU Time`: bigint,
        `JVM GC Time`: bigint,
        `Result Size`: bigint,
        `Memory Bytes Spilled`: bigint,
        `Disk Bytes Spilled`: bigint,
        `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>,
        `Output Metrics`: struct<`Bytes Written`: bigint, `Records Written`: bigint>,
        `Shuffle Read Metrics`: struct<
            `Remote Bytes Read`: bigint,
            `Local Bytes Read`: bigint,
            `Total Records Read`: bigint>,
        `Shuffle Write Metrics`: struct<
            `Shuffle Bytes Written`: bigint,
            `Shuffle Records Written`: bigint>>
"""


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events below ``path``; rolled logs are read from their sub-folders too."""
    return spark.read.schema(TASK_SCHEMA).option("recursiveFileLookup", "true").json(path)

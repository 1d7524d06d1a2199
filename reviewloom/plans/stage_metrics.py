"""Stage metrics of a run, aggregated from Spark's event log."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions import formats
from reviewloom.sources import event_log

# Metric name, and the task field it sums up.
SUMMED = {
    "executorRunTime": "Executor Run Time",
    "executorCpuTime": "Executor CPU Time",
    "jvmGCTime": "JVM GC Time",
    "resultSize": "Result Size",
    "memoryBytesSpilled": "Memory Bytes Spilled",
    "diskBytesSpilled": "Disk Bytes Spilled",
    "recordsRead": "Input Metrics.Records Read",
    "bytesRead": "Input Metrics.Bytes Read",
    "recordsWritten": "Output Metrics.Records Written",
    "bytesWritten": "Output Metrics.Bytes Written",
    "shuffleRecordsRead": "Shuffle Read Metrics.Total Records Read",
    "shuffleRecordsWritten": "Shuffle Write Metrics.Shuffle Records Written",
    "shuffleBytesWritten": "Shuffle Write Metrics.Shuffle Bytes Written",
}


def _field(path: str):
    column = F.col("Task Metrics")
    for name in path.split("."):
        column = column[name]
    return column


def task_ends(events: DataFrame) -> DataFrame:
    return events.filter(F.col("Event") == "SparkListenerTaskEnd")


def per_stage(events: DataFrame) -> DataFrame:
    """One row per stage: tasks, elapsed time and the summed task metrics."""
    launched = F.col("Task Info")["Launch Time"]
    finished = F.col("Task Info")["Finish Time"]
    return (
        task_ends(events)
        .groupBy(F.col("Stage ID").alias("stage_id"))
        .agg(
            F.count(F.lit(1)).alias("numTasks"),
            (F.max(finished) - F.min(launched)).alias("stageDuration"),
            *(
                F.coalesce(F.sum(_field(path)), F.lit(0)).alias(name)
                for name, path in SUMMED.items()
            ),
        )
    )


def overall(stages: DataFrame) -> DataFrame:
    """One row over all stages."""
    summed = ["numTasks", "stageDuration", *SUMMED]
    return stages.agg(
        F.count(F.lit(1)).alias("numStages"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in summed),
    )


def report_lines(totals: DataFrame) -> DataFrame:
    """``name => value`` lines of an ``overall`` row."""
    names = totals.columns
    as_text = totals.select(*(F.col(name).cast("string").alias(name) for name in names))
    return as_text.unpivot([], names, "name", "value").select(
        F.concat_ws(" => ", "name", "value").alias("line")
    )


def parse_report(
    lines: DataFrame, column: str = "line", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``key`` and ``value`` of every report line that holds one pair."""
    return (
        lines.select(*keep, formats.report_pair(F.col(column)).alias("pair"))
        .filter(F.col("pair").isNotNull())
        .select(*keep, "pair.key", "pair.value")
    )


class StageMetrics:
    """Timer of a run, and metrics of the tasks launched between ``begin`` and ``end``.

    The metrics come from the event log, so a session without one has none.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._from: int | None = None
        self._to: int | None = None

    def begin(self) -> None:
        self._from = int(time.time() * 1000)
        self._to = None

    def end(self) -> None:
        if self._from is None:
            raise ValueError("begin was not called")
        self._to = int(time.time() * 1000)

    def _measured(self) -> tuple[int, int]:
        if self._from is None or self._to is None:
            raise ValueError("begin and end must both be called first")
        return self._from, self._to

    def span(self) -> tuple[Column, Column]:
        """Begin and end as timestamp columns."""
        began, ended = self._measured()
        return F.timestamp_millis(F.lit(began)), F.timestamp_millis(F.lit(ended))

    def log_path(self) -> str | None:
        conf = self._spark.sparkContext.getConf()
        if conf.get("spark.eventLog.enabled", "false") != "true":
            return None
        folder = conf.get("spark.eventLog.dir", "file:///tmp/spark-events")
        return f"{folder.rstrip('/')}/*{self._spark.sparkContext.applicationId}*"

    def stages(self) -> DataFrame | None:
        """``per_stage`` of the measured span, or None without an event log."""
        began, ended = self._measured()
        path = self.log_path()
        if path is None:
            return None
        launched = F.col("Task Info")["Launch Time"]
        events = event_log.read_events(self._spark, path)
        return per_stage(events.filter(launched.between(began, ended)))

    def report(self) -> dict[str, str]:
        """Name and value of each metric; one short row is fetched."""
        stages = self.stages()
        if stages is None:
            return {}
        pairs = parse_report(report_lines(overall(stages)))
        return {row["key"]: row["value"] for row in pairs.collect()}

"""Which load dates have been published whole.

A run writes several tables one after the other. It appends a mark before the first write and
one after the last; a load date whose newest run lacks the second is pending, and readers leave
it out until it is run again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from reviewloom.schemas import PARTITION
from reviewloom.sources import parquet

BEGUN = "begun"
COMPLETE = "complete"

LAYOUT = StructType(
    [
        StructField(PARTITION, StringType(), True),
        StructField("run", StringType(), True),
        StructField("state", StringType(), True),
        StructField("at", TimestampType(), True),
        StructField("buckets", IntegerType(), True),
    ]
)


class Days(NamedTuple):
    """``complete``: load dates and the buckets they are clustered into (None: not).
    ``pending``: load dates begun and not completed."""

    complete: dict[str, int | None]
    pending: list[str]

    def before(self, load_date: str) -> str | None:
        """The newest complete load date before ``load_date``."""
        return max((day for day in self.complete if day < load_date), default=None)

    def after(self, load_date: str) -> list[str]:
        """Complete load dates after ``load_date``, in order."""
        return sorted(day for day in self.complete if day > load_date)


def _rows(days: DataFrame, run: str, state: str, buckets: int | None) -> DataFrame:
    values: dict[str, Column] = {
        "run": F.lit(run),
        "state": F.lit(state),
        "at": F.current_timestamp(),
        "buckets": F.lit(buckets).cast("int"),
    }
    return days.select(PARTITION, *(value.alias(name) for name, value in values.items()))


def add(
    spark: SparkSession, path: str, days: list[str], run: str, state: str, buckets: int | None = None
) -> None:
    """Append a mark of ``run`` for each of ``days``."""
    listed = spark.range(1).select(F.explode(F.array(*map(F.lit, days))).alias(PARTITION))
    _rows(listed, run, state, buckets).write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> Days | None:
    """The state of all load dates; None where no run has been marked yet.

    The driver gets one row per load date.
    """
    stored = parquet.scan(spark, path, LAYOUT)
    if stored is None:
        return None
    runs = stored.groupBy(PARTITION, "run").agg(
        F.min("at").alias("begun"),
        F.max(F.col("state") == COMPLETE).alias("done"),
        F.max("buckets").alias("buckets"),
    )
    newest = runs.groupBy(PARTITION).agg(F.max_by(F.struct("done", "buckets"), "begun").alias("last"))
    rows = newest.select(PARTITION, "last.*").collect()
    return Days(
        {r[PARTITION]: r["buckets"] for r in rows if r["done"]},
        sorted(r[PARTITION] for r in rows if not r["done"]),
    )

"""The stored tables of a deployment: snapshots by load date, the ledger and the marks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from reviewloom import schemas
from reviewloom.functions import formats
from reviewloom.operators import ledger as versions
from reviewloom.plans.config import RunConfig
from reviewloom.sinks import buckets, marks, partitions
from reviewloom.sources import history, layouts, parquet

SNAPSHOT = StructType([f for f in schemas.HISTORY.fields if f.name in schemas.REVIEW_FIELDS])
_DATED_LEDGER = StructType(
    [*versions.LEDGER.fields, StructField(schemas.PARTITION, versions.LEDGER[schemas.KEY].dataType)]
)


def days(spark: SparkSession, config: RunConfig) -> marks.Days:
    """Complete and pending load dates.

    Silver that was written before there were marks is taken over once: its load dates are
    marked, and the ledger is built from all its snapshots.
    """
    found = marks.read(spark, config.runs_path)
    if found is not None:
        return found
    silver = parquet.scan(spark, config.silver_path, schemas.HISTORY, base_path=config.silver_path)
    if silver is None:
        return marks.Days({}, [])
    stored = [r[0] for r in silver.select(schemas.PARTITION).distinct().collect()]
    if not stored:
        return marks.Days({}, [])
    rebuild_ledger(spark, config)
    marks.add(spark, config.runs_path, stored, uuid.uuid4().hex, marks.COMPLETE)
    return marks.Days(dict.fromkeys(stored), [])


def rebuild_ledger(spark: SparkSession, config: RunConfig) -> None:
    """The ledger made anew from all snapshots."""
    whole = history.read_history(spark, config.silver_path, "99999999")
    found = versions.versions_of(whole)
    if config.buckets is None:
        partitions.write_partitioned(found, config.ledger_path, compression=LEDGER_COMPRESSION)
    else:
        buckets.write_load_dates(found, config.ledger_path, config.buckets)


def snapshot(spark: SparkSession, config: RunConfig, known: marks.Days, day: str | None) -> DataFrame:
    """One load date's reviews without their histories; none of no day. Clustered by id if
    they were written in the buckets that are configured."""
    if day is None:
        return parquet.empty(spark, SNAPSHOT)
    if config.buckets is not None and known.complete.get(day) == config.buckets:
        whole = buckets.read(spark, config.silver_path, schemas.SILVER, config.buckets)
        return whole.filter(F.col(schemas.PARTITION) == day).select(*SNAPSHOT.fieldNames())
    layout = layouts.with_default(SNAPSHOT, "segmento", formats.NOT_AVAILABLE)
    return day_of(spark, config.silver_path, layout, day)


def ledger(spark: SparkSession, config: RunConfig, known: marks.Days, before: str) -> DataFrame:
    """Versions first seen before the load date ``before``, of complete load dates."""
    if config.buckets is not None:
        found = buckets.read(spark, config.ledger_path, versions.LEDGER, config.buckets)
    else:
        found = parquet.scan(spark, config.ledger_path, _DATED_LEDGER, base_path=config.ledger_path)
        if found is None:
            return parquet.empty(spark, _DATED_LEDGER)
    found = found.filter(F.col(schemas.PARTITION) < before)
    if known.pending:
        found = found.filter(~F.col(schemas.PARTITION).isin(*known.pending))
    return found


def day_of(
    spark: SparkSession, path: str, schema: StructType, day: str
) -> DataFrame:
    """The rows stored for one load date, none if it has no folder."""
    found = parquet.scan(spark, f"{path}/{schemas.PARTITION}={day}", schema)
    return parquet.empty(spark, schema) if found is None else found


# The ledger's codec. Silver and quarantine keep the one that their readers know.
LEDGER_COMPRESSION = "zstd"


def _write(
    frame: DataFrame,
    path: str,
    day: str,
    in_buckets: int | None,
    has_rows: bool | None = None,
    compression: str = partitions.COMPRESSION,
) -> None:
    """Where the table is clustered, the session's codec is used instead."""
    if in_buckets is None:
        partitions.write_load_date(frame, path, day, has_rows=has_rows, compression=compression)
    else:
        buckets.write_load_date(frame, path, day, in_buckets, has_rows=has_rows)


def publish(
    spark: SparkSession,
    config: RunConfig,
    day: str,
    valid: DataFrame,
    invalid: DataFrame,
    new_versions: DataFrame,
    has_valid: bool | None = None,
    has_invalid: bool | None = None,
) -> None:
    """Write a load date's three tables between two marks. Until the second one is there,
    readers leave the load date out, whichever tables a failed run has written."""
    run = uuid.uuid4().hex
    known = marks.read(spark, config.runs_path)
    # on a new load date there is nothing to clear where no version is new
    is_new = known is None or day not in known.complete and day not in known.pending
    marks.add(spark, config.runs_path, [day], run, marks.BEGUN, config.buckets)
    has_versions = True if is_new else None
    _write(new_versions, config.ledger_path, day, config.buckets, has_versions, LEDGER_COMPRESSION)
    partitions.write_load_date(invalid, config.quarantine_path, day, has_rows=has_invalid)
    _write(valid, config.silver_path, day, config.buckets, has_valid)
    marks.add(spark, config.runs_path, [day], run, marks.COMPLETE, config.buckets)

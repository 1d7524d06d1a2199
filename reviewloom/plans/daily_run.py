"""The whole run of one load date, from raw files to silver, quarantine and metrics."""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import schemas, session
from reviewloom.operators import joins, quality, sizing
from reviewloom.operators import ledger as versions
from reviewloom.operators.standardize import conform, conformed, standardize_reviews
from reviewloom.plans import documents, lake, replay
from reviewloom.plans.config import RunConfig
from reviewloom.plans.stage_metrics import StageMetrics
from reviewloom.sinks import marks, metrics
from reviewloom.sources import bronze

log = logging.getLogger(__name__)


# What a stored byte may take in a shuffle, where rows are not compressed by column.
SHUFFLED = 4

# Name of the column that tells the batch's ids among the merged rows.
IN_BATCH = "_in_batch"


class Curated(NamedTuple):
    """One load date: complete rows, rejected and incomplete ones, versions not seen before
    it, and the counters of the checks."""

    valid: DataFrame
    rejected: DataFrame
    incomplete: DataFrame
    versions: DataFrame
    counts: DataFrame

    @property
    def invalid(self) -> DataFrame:
        return self.rejected.unionByName(self.incomplete)

    @property
    def report(self) -> DataFrame:
        return quality.validation_report(self.counts)


class Published(NamedTuple):
    """A load date as stored, with the counters and the report of its checks."""

    valid: DataFrame
    invalid: DataFrame
    report: DataFrame
    counts: DataFrame


def read_batch(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Raw reviews of the load date, all segments."""
    return bronze.read_segments(spark, config.segment_globs(), store=config.store, segments=config.segments)


def curate(
    spark: SparkSession,
    batch: DataFrame,
    config: RunConfig,
    known: marks.Days | None = None,
    only: DataFrame | None = None,
) -> Curated:
    """Merge ``batch`` with what is stored of earlier load dates, check it and split it.

    Of those only the newest snapshot and the ledger's entries of the batch's ids are read.
    ``only``, a stored table of ids, restricts all of it to those. Keys are tallied once;
    the mergeable rows, their ledger entries and the merged rows are written to the scratch
    folder, as each is used several times; the first where there is a history to merge them
    with, as they are the merged rows otherwise. Counters are gathered while rows are written.
    """
    known = lake.days(spark, config) if known is None else known
    newest = lake.snapshot(spark, config, known, known.before(config.as_of))
    ledger = lake.ledger(spark, config, known, config.as_of)
    stored_bytes = sizing.file_bytes(newest) if newest.inputFiles() else 0
    has_history = known.before(config.as_of) is not None
    if only is not None:
        batch = joins.rows_with_keys(batch, only, schemas.KEY, stored=True)
        newest = joins.rows_with_keys(newest, only, schemas.KEY, stored=True)
    tally = session.store(batch.groupBy(schemas.KEY).agg(F.count(F.lit(1)).alias("n")))
    named = tally.filter(F.col(schemas.KEY).isNotNull())
    repeated = named.filter(F.col("n") > 1).select(schemas.KEY)
    ids = named.filter(F.col("n") == 1).select(schemas.KEY)
    new = standardize_reviews(quality.unique_rows(batch, repeated=repeated)).select(*schemas.REVIEW_FIELDS)
    if has_history:
        new = session.store(new, compression=session.COMPACT)
        session.size_shuffles(spark, SHUFFLED * (sizing.file_bytes(new) + stored_bytes))
    entries = session.store(
        versions.known_versions(ledger, ids, config.broadcast_limit), compression=session.COMPACT
    )
    merged = versions.merge_with_ledger(new, newest, entries, config.broadcast_limit, IN_BATCH)
    current, counted = session.store_counted(
        merged.select(*conformed(merged, schemas.SILVER), IN_BATCH),
        *quality.unique_counters(),
        compression=session.COMPACT,
    )
    complete = current.filter(quality.is_complete())
    valid = complete.drop(IN_BATCH)
    incomplete = current.filter(~quality.is_complete()).drop(IN_BATCH).withColumn(
        "reasons", quality.null_reasons()
    )
    rejected = quality.reject_keys(batch, finish=standardize_reviews, repeated=repeated).withColumn(
        "historical_data", F.array().cast(schemas.SILVER["historical_data"].dataType)
    )
    from_batch = complete.filter(IN_BATCH).select(schemas.KEY, *schemas.PAYLOAD)
    return Curated(
        valid,
        conform(rejected, schemas.QUARANTINE),
        incomplete,
        versions.new_versions(from_batch, entries),
        _run_counts(spark, tally, counted),
    )


def _run_counts(spark: SparkSession, tally: DataFrame, counted: dict[str, int]) -> DataFrame:
    """Counters of the run as one literal row.

    Keys are counted from their stored tally, as they repeat in the batch only; content was
    counted as the merged rows were written.
    """
    named = F.col(schemas.KEY).isNotNull()
    lost = ~named | (F.col("n") > 1)
    keys = tally.agg(
        F.count_if(named & (F.col("n") > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("no_key"),
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("rejected"),
    ).first()
    counts = {
        **counted,
        "duplicate_keys": keys["repeated"],
        "null_id": keys["no_key"],
        "invalid": counted["total_records"] - counted["valid"] + keys["rejected"],
    }
    counts["written_total"] = counts["valid"] + counts["invalid"]
    return spark.range(1).select(
        *(F.lit(count).cast("bigint").alias(name) for name, count in counts.items())
    )


def save(spark: SparkSession, curated: Curated, config: RunConfig) -> Published:
    """Write the load date's tables and return it as stored."""
    counted = curated.counts.first()
    lake.publish(
        spark,
        config,
        config.as_of,
        curated.valid,
        curated.invalid,
        curated.versions,
        counted["valid"] > 0,
        counted["invalid"] > 0,
    )
    day = config.as_of
    return Published(
        lake.day_of(spark, config.silver_path, schemas.SILVER, day),
        lake.day_of(spark, config.quarantine_path, schemas.QUARANTINE, day),
        curated.report,
        curated.counts,
    )


def run(spark: SparkSession, config: RunConfig) -> Published:
    """Run the load date. A failure is recorded and raised again.

    Later load dates that have been run already are brought up to date. Scratch tables are
    removed at the end.
    """
    batch = None
    try:
        stages = StageMetrics(spark)
        stages.begin()
        with session.removed_scratch(spark):
            batch = read_batch(spark, config)
            known = lake.days(spark, config)
            curated = curate(spark, batch, config, known)
            if config.env == config.sample_env:
                _show_sample(curated)
            changed = replay.changed_by(spark, curated, config, known)
            published = save(spark, curated, config)
            replay.replay(spark, config, changed, known.after(config.as_of), curate, read_batch)
        stages.end()
        pairs = [F.lit(text) for pair in stages.report().items() for text in pair]
        document = documents.success_document(
            published.counts,
            quality.segment_names(published.valid).scalar(),
            spark.sparkContext.applicationId,
            *stages.span(),
            F.current_timestamp(),
            F.create_map(*pairs) if pairs else None,
            config.labels,
        )
        metrics.save_run("success", config.metrics, config.success_index, document)
        return published
    except Exception as error:
        _record_failure(spark, config, batch, error)
        raise


def _show_sample(curated: Curated) -> None:
    for name, frame in (("valid", curated.valid), ("invalid", curated.invalid)):
        for row in quality.sample(frame).collect():
            log.info("%s: %s", name, row)


def _record_failure(
    spark: SparkSession, config: RunConfig, batch: DataFrame | None, error: Exception
) -> None:
    """Best effort: the caller raises the original error whatever happens here."""
    unknown = spark.range(1).select(F.array().cast("array<string>").alias("names"))
    attempts = [unknown] if batch is None else [quality.segment_names(batch), unknown]
    for clients in attempts:
        try:
            document = documents.failure_document(
                clients, str(error), F.current_timestamp(), config.labels
            )
            metrics.save_run("fail", config.metrics, config.fail_index, document, error)
            return
        except Exception:
            log.exception("the failure of the run could not be recorded")

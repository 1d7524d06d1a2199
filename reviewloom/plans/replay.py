"""Later load dates brought up to date after an earlier one was run late or again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom import schemas
from reviewloom.operators import joins, quality
from reviewloom.operators import ledger as versions
from reviewloom.plans import lake
from reviewloom.plans.config import RunConfig
from reviewloom.sinks import marks


class Changed(NamedTuple):
    """What a run changes for later load dates: the ``ids``, a stored table; None: any."""

    ids: DataFrame | None


def changed_by(spark: SparkSession, curated: Any, config: RunConfig, known: marks.Days) -> Changed | None:
    """The ids whose rows later load dates were not based on; None if there are no later ones.

    They were based on the load date's earlier result or, where it had not been run, on the
    snapshot before it. After a run that failed midway that is not known. To be called before
    the load date is written.
    """
    if not known.after(config.as_of):
        return None
    if config.as_of in known.pending:
        return Changed(None)
    base = config.as_of if config.as_of in known.complete else known.before(config.as_of)
    before = lake.snapshot(spark, config, known, base)
    after = curated.valid.select(*schemas.REVIEW_FIELDS)
    return Changed(versions.stored_changes(before, after))


def replay(
    spark: SparkSession,
    config: RunConfig,
    changed: Changed | None,
    later: list[str],
    curate: Callable[..., Any],
    read_batch: Callable[[SparkSession, RunConfig], DataFrame],
) -> None:
    """Run the load dates ``later``, in order, again for the ids that ``changed``.

    Rows of other ids are taken over from what is stored. The ids stay the same from day to
    day: even where a later batch gives an id the row that it had, its history has changed.
    Metrics documents of those days are left as they were.
    """
    if changed is None or changed.ids is not None and changed.ids.isEmpty():
        return
    for day in later:
        again = replace(config, as_of=day)
        known = lake.days(spark, config)
        curated = curate(spark, read_batch(spark, again), again, known, changed.ids)
        if changed.ids is None:
            lake.publish(spark, config, day, curated.valid, curated.invalid, curated.versions)
            continue
        kept = lambda path, schema: joins.rows_with_keys(
            lake.day_of(spark, path, schema, day), changed.ids, schemas.KEY, "left_anti", stored=True
        )
        # rejected keys depend on the day's batch alone
        quarantined = lake.day_of(spark, config.quarantine_path, schemas.QUARANTINE, day)
        by_key = F.col(schemas.KEY).isNull() | F.array_contains("reasons", quality.DUPLICATE_REASON)
        others = joins.rows_with_keys(
            quarantined.filter(~by_key), changed.ids, schemas.KEY, "left_anti", stored=True
        )
        # each is read from the partition that it replaces, which Spark does once the new
        # files are all written beside it
        valid = kept(config.silver_path, schemas.SILVER).unionByName(curated.valid)
        invalid = quarantined.filter(by_key).unionByName(others).unionByName(curated.incomplete)
        ledger = kept(config.ledger_path, versions.LEDGER).unionByName(curated.versions)
        lake.publish(spark, config, day, valid, invalid, ledger)

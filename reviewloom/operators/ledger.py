"""The ledger of versions: each payload that an id ever had, once, with the load date on which
it was first seen.

It says what a pass over all earlier snapshots would say, and grows with the changes and not
with days times population.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewloom import session
from reviewloom.functions import digests
from reviewloom.operators import joins, merge, quality, sizing
from reviewloom.schemas import KEY, PAYLOAD, PARTITION, REVIEW_FIELDS, SILVER

# Name of the digest column within this module.
DIGEST = "_version_digest"

NESTED = SILVER["historical_data"].dataType

# As stored; the load date is the partition column.
LEDGER = StructType([StructField(name, StringType(), True) for name in (KEY, *PAYLOAD)])


def versions_of(history: DataFrame) -> DataFrame:
    """The ledger of whole snapshots: a full rebuild."""
    found = merge.distinct_versions(history)
    return found.select(KEY, *PAYLOAD, F.col("first_seen").cast("string").alias(PARTITION))


def known_versions(
    ledger: DataFrame, ids: DataFrame, broadcast_limit: int = sizing.BROADCAST_LIMIT
) -> DataFrame:
    """The entries of ``ids`` (distinct). The ids go to the ledger as a broadcast or, if they
    are too many, by a join on the id alone, for which a bucketed ledger stays in place."""
    if sizing.is_small(ids, broadcast_limit):
        return ledger.join(F.broadcast(ids), KEY, "left_semi")
    return ledger.join(ids, KEY, "left_semi")


def new_versions(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Versions among ``rows`` that ``known``, all entries of their ids, has not got.

    Versions are matched by digests of id and payload, sent to the rows where they are few.
    Only versions that occur in several rows, as their tallied digests tell, are shuffled to
    be made distinct; other rows stay in place.
    """
    columns = [KEY, *PAYLOAD]
    digest = digests.text_digest(columns).alias(DIGEST)
    found = rows.filter(F.col(KEY).isNotNull()).select(*columns, digest)
    seen = session.store(known.select(digest).distinct())
    fresh = joins.rows_with_keys(found, seen, DIGEST, "left_anti", stored=True)
    repeated = session.store(quality.duplicate_keys(fresh, DIGEST).select(DIGEST))
    if repeated.isEmpty():
        return fresh.select(*columns)
    once = joins.rows_with_keys(fresh, repeated, DIGEST, "left_anti", stored=True)
    copies = joins.rows_with_keys(fresh, repeated, DIGEST, stored=True)
    return once.select(*columns).unionByName(copies.select(*columns).distinct())


def _as_versions(known: DataFrame, prefix: str = "") -> DataFrame:
    """Entries with the load date they were first seen on as a number."""
    payload = (F.col(n).cast("string").alias(f"{prefix}{n}") for n in PAYLOAD)
    return known.select(KEY, merge.load_day(known).alias("first_seen"), *payload)


def replaced_versions(new: DataFrame, known: DataFrame, small: bool = False) -> DataFrame:
    """One row per entry of ``known`` that ``new`` (one row per id) replaces, as
    ``merge.change_rows`` finds them in whole snapshots."""
    versions = _as_versions(known, "old_")
    batch = merge.tracked_values(new)
    if small:
        return merge.replaced(versions.join(F.broadcast(batch), KEY))
    return merge.replaced(joins.salted_join(versions, batch, KEY))


def merge_with_ledger(
    new: DataFrame,
    newest: DataFrame,
    known: DataFrame,
    broadcast_limit: int = sizing.BROADCAST_LIMIT,
    mark: str | None = None,
) -> DataFrame:
    """What ``merge.merge_snapshots`` makes of ``new`` and the whole history.

    ``newest`` is the last snapshot, which has every earlier id; ``known`` are the ledger's
    entries of the new ids, a stored table. ``mark`` names a column that says which ids are
    among the new ones.

    Without entries nothing is replaced, and the new rows are not joined with any. Where the
    new values are too many to be sent to the entries, these are gathered by id and compared
    beside the new row, which is so shuffled once; hot ids are compared before instead.
    """
    if known.isEmpty():
        nothing = F.array().cast(NESTED)
        merged = merge.current_snapshot(new, newest, mark=mark)
        return merged.select(*REVIEW_FIELDS, nothing.alias("historical_data"), *([mark] if mark else []))
    small = sizing.is_small(merge.tracked_values(new), broadcast_limit)
    if small or not joins.hot_keys(known, KEY).isEmpty():
        nested, entries = merge.nest_changes(replaced_versions(new, known, small)), None
    else:
        nested = _as_versions(known).groupBy(KEY).agg(merge.in_order().alias("versions"))
        entries = merge.replaced_entries(F.col("versions"))
    return merge.without_gaps(merge.current_snapshot(new, newest, nested, entries, mark))


def changed_ids(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids whose row differs between two snapshots, or that only one of them has.

    Only ids and digests are shuffled.
    """
    names = [name for name in before.columns if name in after.columns]

    def marked(frame: DataFrame, digest: str) -> DataFrame:
        return frame.select(KEY, digests.row_digest(frame, names).alias(digest))

    both = marked(before, "was").join(marked(after, "is"), KEY, "full_outer")
    return both.filter(~F.col("was").eqNullSafe(F.col("is"))).select(KEY)


def stored_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``changed_ids`` as a written table, for snapshots that are about to be replaced."""
    return session.store(changed_ids(before, after))

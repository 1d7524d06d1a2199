"""One day's reviews merged with earlier snapshots, replaced versions kept."""

from __future__ import annotations

from functools import reduce
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from reviewloom import session
from reviewloom.operators import bitmaps, joins, sizing
from reviewloom.schemas import HISTORY_ENTRY, KEY, PARTITION, PAYLOAD, REVIEW_FIELDS, TRACKED

_CARRIED = tuple(name for name in REVIEW_FIELDS if name != KEY)


def differs(name: str, old: Column | None = None) -> Column:
    """New and old value both present and different."""
    old = F.col(f"old_{name}") if old is None else old
    return F.coalesce(F.col(f"new_{name}") != old, F.lit(False))


def change_flag() -> Column:
    return reduce(Column.__or__, [differs(name) for name in TRACKED])


def change_label() -> Column:
    """The first tracked column that differs, null when none does."""
    return F.coalesce(*(F.when(differs(name), F.lit(name)) for name in TRACKED))


def load_day(history: DataFrame) -> Column:
    """The load date, ``yyyyMMdd`` text as a number.

    Text has no fixed width, so its minimum or maximum per key would be found by
    sorting rows; that of a number is found by hashing keys.
    """
    column = F.col(PARTITION)
    if isinstance(history.schema[PARTITION].dataType, StringType):
        return column.cast("int")
    return column


def tally_history(history: DataFrame) -> DataFrame:
    """Per id: ``n`` earlier rows and the ``newest`` load date. Reads two columns."""
    return (
        history.filter(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("n"), F.max(load_day(history)).alias("newest"))
    )


def since_all_newest(history: DataFrame, tally: DataFrame) -> DataFrame:
    """Only the load dates from which every id's newest row comes.

    Each stored day is a full snapshot, so this is mostly the last folder; the
    others are pruned before they are read.
    """
    oldest = tally.agg(F.min("newest").cast(history.schema[PARTITION].dataType))
    return history.filter(F.col(PARTITION) >= oldest.scalar())


def latest_rows(history: DataFrame, tally: DataFrame | None = None) -> DataFrame:
    """Per id the row with the greatest load date. An id has one row per load date.

    The greatest date is found on two narrow columns; wide rows are only fetched where
    they have it. ``tally`` is ``tally_history(history)`` where that is stored already.
    """
    newest = (tally_history(history) if tally is None else tally).select(KEY, "newest")
    rows = history.select(KEY, *_CARRIED, load_day(history).alias("day"))
    # not an equality: rows stay hashed by id alone, as later joins need them
    return rows.join(newest, KEY).filter(F.col("day") >= F.col("newest")).select(KEY, *_CARRIED)


def distinct_versions(history: DataFrame) -> DataFrame:
    """Per id and distinct payload the first load date it was seen on.

    Grouping by the payload too spreads an id with many versions over tasks and
    combines unchanged copies before the shuffle.
    """
    return (
        history.filter(F.col(KEY).isNotNull())
        .groupBy(KEY, *PAYLOAD)
        .agg(F.min(load_day(history)).alias("first_seen"))
    )


def tracked_values(new: DataFrame) -> DataFrame:
    """The id and what changes are found by, as ``new_<name>``."""
    return new.select(KEY, *(F.col(name).alias(f"new_{name}") for name in TRACKED))


def replaced(pairs: DataFrame) -> DataFrame:
    """Of earlier versions (``old_<name>``) beside the new values of their id those that
    differ in a tracked column."""
    return pairs.filter(change_flag()).select(
        KEY,
        "first_seen",
        *(F.col(f"old_{name}").cast("string").alias(name) for name in PAYLOAD),
    )


def change_rows(
    new: DataFrame,
    history: DataFrame,
    small: bool = False,
) -> DataFrame:
    """One row per distinct earlier version that ``new`` replaces.

    ``new`` has one row per id. When it is ``small`` (measured), it is sent to
    the history and only replaced versions are shuffled; otherwise versions are
    made distinct first and joined with hot ids salted.
    """
    batch = tracked_values(new)
    as_old = [F.col(name).alias(f"old_{name}") for name in PAYLOAD]
    if small:
        pairs = history.select(KEY, load_day(history).alias("first_seen"), *as_old).join(
            F.broadcast(batch), KEY
        )
        found = replaced(pairs)
        return found.groupBy(KEY, *PAYLOAD).agg(F.min("first_seen").alias("first_seen"))
    # stored, as it is measured before it is joined
    versions = session.store(distinct_versions(history).select(KEY, "first_seen", *as_old))
    return replaced(joins.salted_join(versions, batch, KEY))


def nest_changes(changes: DataFrame) -> DataFrame:
    """Replaced versions of each id as one array, in order of first load date.

    The array has at most one entry per load date, as a stored day has one row per id.
    """
    entries = _payloads(in_order())
    return changes.groupBy(KEY).agg(entries.alias("historical_data"))


def in_order() -> Column:
    """Aggregate: the versions of a group as one array, in order of first load date."""
    return F.sort_array(F.collect_list(F.struct("first_seen", *PAYLOAD)))


def _payloads(versions: Column) -> Column:
    return F.transform(versions, lambda e: F.struct(*(e[name].alias(name) for name in PAYLOAD)))


def replaced_entries(versions: Column) -> Column:
    """Of an id's ``versions``, an array as ``in_order`` makes it, those that the new values
    (``new_<name>``) beside it replace, as a nested history."""
    return _payloads(
        F.filter(versions, lambda e: reduce(Column.__or__, [differs(n, e[n]) for n in TRACKED]))
    )


def current_snapshot(
    new: DataFrame,
    latest: DataFrame,
    nested: DataFrame | None = None,
    entries: Column | None = None,
    mark: str | None = None,
) -> DataFrame:
    """One row per id of either side: new values, old ones where the new are null.

    Every input has one row per id. ``nested`` is attached to the new rows, the
    only ones that can have replaced something, before the outer join: the
    frames are then all partitioned by id and are shuffled once. ``entries`` is made the
    nested history where ``nested`` has no such column yet. With ``mark`` a column of that
    name says whether the id is among the new ones.
    """
    batch = joins.prefixed(new.select(*REVIEW_FIELDS), "new", KEY)
    columns = [F.coalesce(f"new_{name}", f"old_{name}").alias(name) for name in _CARRIED]
    if mark is not None:
        batch = batch.withColumn(mark, F.lit(True))
    if nested is not None:
        batch = batch.join(nested, KEY, "left")
        entries = F.col("historical_data") if entries is None else entries
        columns.append(entries.alias("historical_data"))
    if mark is not None:
        columns.append(F.coalesce(mark, F.lit(False)).alias(mark))
    old = joins.prefixed(latest.select(*REVIEW_FIELDS), "old", KEY)
    return batch.join(old, KEY, "full_outer").select(KEY, *columns)


def merge_snapshots(
    new: DataFrame,
    history: DataFrame,
    tally: DataFrame | None = None,
    broadcast_limit: int = sizing.BROADCAST_LIMIT,
    prune: bool = False,
) -> DataFrame:
    """Merge one day's reviews (one row per non-null id) with the earlier ones.

    ``tally`` is ``tally_history(history)``, given by callers that have stored
    it. ``prune`` is for histories partitioned by load date: the newest rows are
    then read only from the folders that hold them.
    """
    if tally is None:
        tally = tally_history(history)
    latest = latest_rows(since_all_newest(history, tally) if prune else history, tally)
    small = sizing.is_small(new.select(KEY, *TRACKED), broadcast_limit)
    if not small:
        history = rows_of_batch(history, new.select(KEY), broadcast_limit)
    nested = nest_changes(change_rows(new, history, small))
    return without_gaps(current_snapshot(new, latest, nested))


def rows_of_batch(
    history: DataFrame, ids: DataFrame, broadcast_limit: int = sizing.BROADCAST_LIMIT
) -> DataFrame:
    """Rows of ``history`` whose id is in ``ids`` (distinct), and maybe few others.

    The ids are sent to the history where they may be, else a bitmap of their hashes:
    either way other rows are dropped where they are read.
    """
    if sizing.is_small(ids, broadcast_limit):
        return history.join(F.broadcast(ids), KEY, "left_semi")
    return bitmaps.likely_rows(history, ids, KEY, broadcast_limit)


def without_gaps(snapshot: DataFrame) -> DataFrame:
    """An empty history instead of a null one."""
    none = F.array().cast(snapshot.schema["historical_data"].dataType)
    return snapshot.withColumn("historical_data", F.coalesce("historical_data", none))


def entries_text(history: Column) -> Column:
    """A nested history as text, for comparison and display."""
    fields = [f.name for f in HISTORY_ENTRY.fields]
    return F.array_join(
        F.transform(
            history,
            lambda e: F.concat_ws("|", *(F.coalesce(e[name], F.lit("")) for name in fields)),
        ),
        ";",
    )

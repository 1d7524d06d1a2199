"""Outer merge in parts, and joins that survive a key holding much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.operators import sizing

# A key is hot when its rows take more than one task should hold.
TASK_BYTES = session.PARTITION_BYTES

PART_SUFFIX = "_part"


def prefixed(frame: DataFrame, prefix: str, key: str) -> DataFrame:
    """All columns but the key renamed to ``<prefix>_<name>``."""
    return frame.select(
        key, *(F.col(name).alias(f"{prefix}_{name}") for name in frame.columns if name != key)
    )


def key_tally(frame: DataFrame, key: str) -> DataFrame:
    """Rows per key, ``n``. Counts are combined before the shuffle."""
    return frame.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(frame: DataFrame, key: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Keys whose rows take more than ``task_bytes`` as text, and in how many ``parts``
    of that size they go. Sizes are combined before the shuffle."""
    return (
        frame.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(sizing.row_bytes(frame)).alias("bytes"))
        .filter(F.col("bytes") > task_bytes)
        .select(key, F.ceil(F.col("bytes") / task_bytes).cast("int").alias("parts"))
    )


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Equi-join with the hot keys of ``left`` spread over several tasks.

    ``right`` has one row per key; only its rows of hot keys are repeated, once
    per part. ``left`` rows of a key are spread by their content and by the
    partition they come from, so copies are spread too. The list of hot keys
    is sent to all tasks only if it has been measured to be small. A join that
    keeps unmatched right rows would keep each repeat, so those are refused.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot keep unmatched right rows: {how}")
    part = f"{key}{PART_SUFFIX}"
    hot = session.store(hot_keys(left, key, task_bytes))
    if sizing.is_small(hot):
        hot = F.broadcast(hot)
    parts = F.coalesce(F.col("parts"), F.lit(1))
    salt = F.xxhash64(F.spark_partition_id(), *left.columns)
    spread = (
        left.withColumn(part, salt)
        .join(hot, key, "left")
        .withColumn(part, F.pmod(F.col(part), parts).cast("int"))
        .drop("parts")
    )
    repeated = (
        right.join(hot, key, "left")
        .withColumn(part, F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("parts")
    )
    return spread.join(repeated, [key, part], how).drop(part)


def rows_with_keys(
    frame: DataFrame,
    counted: DataFrame,
    key: str,
    how: str = "left_semi",
    broadcast_limit: int = sizing.BROADCAST_LIMIT,
    task_bytes: int = TASK_BYTES,
    stored: bool = False,
) -> DataFrame:
    """Rows of ``frame`` whose key is in ``counted`` (one row per key), copies included;
    with ``how="left_anti"`` those whose key is not. ``stored`` says that ``counted`` is a
    written table.

    Keys that have been measured to be few are sent to the rows, which then stay in
    place; else rows are matched with hot keys spread over several tasks.
    """
    keys = counted.select(key) if stored else session.store(counted.select(key))
    if sizing.is_small(keys, broadcast_limit):
        return frame.join(F.broadcast(keys), key, how)
    return salted_join(frame, keys, key, how, task_bytes)


def outer_in_parts(
    kept: DataFrame,
    looked_up: DataFrame,
    key: str,
    small: bool = False,
    salted: bool = False,
) -> DataFrame:
    """Full outer equi-join as a left join plus the unmatched rest of ``looked_up``.

    A full outer join itself can be neither broadcast nor salted; its left half
    can. ``small`` says that ``looked_up`` has been measured and may be
    broadcast. The rest is found against the distinct keys only.
    """
    if small:
        matched = kept.join(F.broadcast(looked_up), key, "left")
    elif salted:
        matched = salted_join(kept, looked_up, key, "left")
    else:
        matched = kept.join(looked_up, key, "left")
    rest = looked_up.join(kept.select(key).distinct(), key, "left_anti")
    return matched.unionByName(rest, allowMissingColumns=True)

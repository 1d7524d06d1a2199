"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import session

# Texts are equal if they are after this.
BLANKS = r"[\x20\x09-\x0D]+"

# Runs that meet in a merge, and distinct texts that one holder is meant to end with.
FAN = 16
HELD = 10_000

# A group with more than this part of all rows is hot: there are fewer such groups than
# the number says, so the list of them is sent to the rows.
HOT_PART = 1000

_ORDER = ["holder", "digest", "sha256", "no_id", "doc_id", "row"]


def normalised(text: Column) -> Column:
    """Every run of blanks as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def _digested(documents: DataFrame) -> DataFrame:
    """A stored narrow table: one entry per row with its 64-bit digest and SHA-256.

    ``row`` tells apart rows that repeat an id; being stored, it never changes.
    """
    text = normalised(F.col("text"))
    return session.store(
        documents.select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64(text).alias("digest"),
            F.unhex(F.sha2(text, 256)).alias("sha256"),
        )
    )


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of neighbours with one digest and one SHA-256 the first, with the sum of their ``n``.

    The rows come in ``_ORDER``, so the first has the smallest id; ``n`` is the last column. The last group of a
    batch waits for the next one; nothing else is held.
    """
    waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if waiting is not None:
            batch = pa.Table.from_batches([waiting, batch]).combine_chunks().to_batches()[0]
        begins = np.ones(batch.num_rows, bool)
        begins[1:] = False
        for name in ("holder", "digest", "sha256"):
            column = batch.column(name)
            begins[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(begins)
        sums = np.add.reduceat(batch.column("n").to_numpy(), starts)
        firsts = batch.take(pa.array(starts))
        columns = [*firsts.columns[:-1], pa.array(sums)]
        folded = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
        yield folded.slice(0, folded.num_rows - 1)
        waiting = folded.slice(folded.num_rows - 1)
    if waiting is not None:
        yield waiting


def _merged_runs(runs: DataFrame) -> DataFrame:
    """One sorted run per holder from all that it has been sent. Spark's sort merges
    them, on disk where they do not fit."""
    return runs.sortWithinPartitions(*_ORDER).mapInArrow(_folded, runs.schema)


def tree_merge(rows: DataFrame, levels: int, fan: int = FAN) -> DataFrame:
    """Distinct texts of ``rows`` (a stored table: ``doc_id``, ``row``, ``digest``,
    ``sha256``), each with its smallest identifier and number of rows ``n``.

    There are ``fan ** levels`` holders. Every partition is first made one sorted run
    without a shuffle. In round r the holders that differ only in digit r (base ``fan``)
    exchange pieces of their runs: each takes the digests that have its own digit there.
    It merges the pieces and retains, per digest and SHA-256, the smallest identifier.
    After the last round a holder has all entries of its digests. A group of copies is one
    entry per run from the first level on, however many rows it has.
    """
    holders = fan**levels
    level = _merged_runs(
        rows.select(
            F.pmod(F.spark_partition_id(), F.lit(holders)).alias("holder"),
            "digest",
            "sha256",
            F.col("doc_id").isNull().alias("no_id"),
            "doc_id",
            "row",
            F.lit(1).cast("long").alias("n"),
        )
    )
    owner = F.pmod(F.col("digest"), F.lit(holders))
    for step in (fan**r for r in range(levels)):
        own = F.floor(F.col("holder") / step) % fan
        due = F.floor(owner / step) % fan
        moved = (F.col("holder") + (due - own) * step).cast("int")
        level = _merged_runs(level.withColumn("holder", moved).repartition("holder"))
    return level.drop("holder", "no_id")


def levels_for(rows: int, fan: int = FAN, held: int = HELD) -> int:
    """Rounds after which no holder is expected to have more than ``held`` texts."""
    levels = 1
    while fan**levels * held < rows:
        levels += 1
    return levels


def _grouped(rows: DataFrame, fan: int, held: int) -> DataFrame:
    """Every entry of ``rows`` with its group's ``keep_id``, ``keep_row`` and ``n``."""
    total = rows.count()
    groups = session.store(
        tree_merge(rows, levels_for(total, fan, held), fan).select(
            "digest", "sha256", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "n"
        )
    )
    text = ["digest", "sha256"]
    is_hot = F.col("n") > total // HOT_PART
    hot = F.broadcast(groups.filter(is_hot))
    others = rows.join(hot.select(*text), text, "left_anti")
    return rows.join(hot, text).unionByName(others.join(groups.filter(~is_hot), text))


def duplicates(documents: DataFrame, fan: int = FAN, held: int = HELD) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``keep_id``, ``group_size``, ``kept`` and
    ``text_sha256`` of the normalised text.

    Of texts equal after each run of blanks is made one space, the row with the smallest
    id stays, null last; of rows that repeat that id one stays. Null texts are empty texts.
    A group without an id has a null ``keep_id`` and keeps one row. Other columns are not
    read. An empty table gives an empty result.
    """
    return _grouped(_digested(documents), fan, held).select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def without_copies(documents: DataFrame, fan: int = FAN, held: int = HELD) -> DataFrame:
    """The rows of ``documents`` that ``duplicates`` keeps, with all their columns.

    Of rows that repeat an id and a text but differ in other columns, any one stays.
    """
    staying = duplicates(documents, fan, held).filter("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_sha256")
    )
    whole = documents.select(
        F.struct("*").alias("doc"), F.col("doc_id"), F.sha2(normalised(F.col("text")), 256).alias("sha256")
    )
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("sha256") == F.col("kept_sha256"))
    return whole.join(staying, same, "left_semi").dropDuplicates(["doc_id", "sha256"]).select("doc.*")

"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from reviewloom import session
from reviewloom.llm.common import bounded_batches, per_text
from reviewloom.llm.components import components

SHINGLE = 4
MOST_BITS = 4
SEED = 42

# A fingerprint's segments, (lowest bit, bits). Of 4 differing bits in three segments,
# either one of the first two holds at most 1, or the third holds none.
SEGMENTS = ((0, 22, 1), (22, 21, 1), (43, 21, 0))

# A bucket with more fingerprints is not compared pair by pair but by common neighbours,
# of which a fingerprint has 947: beyond about as many members that is less work, and it
# grows with the bucket's size and not with its square. Both ways find every link.
PAIRWISE = 1024

# Sums of 255 ones fit a byte.
_BLOCK = 255
_LOWEST = np.uint64(0x0101010101010101)


def fingerprint(text: str) -> int:
    """Bit i is 1 where it is set in more than half of the shingles' hashes."""
    # as bytes, lower() changes A to Z only and split() cuts at the six ASCII blanks only
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= SHINGLE:
        return xxh64_intdigest(joined, SEED)
    lengths = np.array(list(map(len, found)), np.int64)
    ends = np.cumsum(lengths + 1) - 1
    size = len(found) - SHINGLE + 1
    spans = zip((ends - lengths)[:size].tolist(), ends[SHINGLE - 1 :].tolist())
    hashes = np.array([xxh64_intdigest(joined[i:j], SEED) for i, j in spans], np.uint64)
    # eight bits at a time: each byte of a sum counts one bit over a block of hashes
    padded = np.zeros((-(-size // _BLOCK), _BLOCK), np.uint64)
    padded.ravel()[:size] = hashes
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):
        sums = ((padded >> np.uint64(bit)) & _LOWEST).sum(axis=1)
        counts[:, bit] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    ones = np.packbits(counts.ravel() * 2 > size, bitorder="little")
    return int(ones.view("<u8")[0])


def _make() -> Callable[[str], tuple]:
    return lambda text: (_signed(fingerprint(text)),)


_computed = per_text(_make, "bits long")


def fingerprinted(text: Column) -> Column:
    """The fingerprint of each text as a signed 64-bit number; null and blank texts: 0."""
    return _computed(text)["bits"]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _flips(low: int, bits: int, most: int) -> list[int]:
    """Masks that change at most ``most`` of a segment's bits, as signed numbers."""
    masks = [0]
    if most:
        masks += [1 << b for b in range(low, low + bits)]
    return [_signed(m) for m in masks]


def _segment_key(low: int, bits: int, value: Column) -> Column:
    return F.shiftrightunsigned(value, low).bitwiseAND((1 << bits) - 1)


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fingerprints: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints (``bits``) that connect all those
    that are 4 or fewer bits apart. ``fingerprints`` should be a stored table.

    Every fingerprint is stored by each of its three segments. The small Hamming ball
    around each of its segments is enumerated, the table's matches are fetched and their
    complete distance is verified. The members of a bucket of more than ``pairwise``
    fingerprints, as large groups of near copies make, are linked by ``_by_neighbours``.
    """
    found = []
    for low, bits, near in SEGMENTS:
        keyed = fingerprints.select("bits", _segment_key(low, bits, F.col("bits")).alias("key"))
        crowded = session.store(
            keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > pairwise)
        ).select("key")
        probes = fingerprints.select(
            F.col("bits").alias("a"),
            F.explode(F.array(*map(F.lit, _flips(low, bits, near)))).alias("flip"),
        ).select(
            "a",
            F.col("flip") != 0,
            _segment_key(low, bits, F.col("a").bitwiseXOR(F.col("flip"))).alias("key"),
        ).toDF("a", "beside", "key")
        if crowded.isEmpty():
            table = keyed
        else:
            table = keyed.join(crowded, "key", "left_anti")
            found.append(_by_neighbours(probes.join(crowded, "key"), low, bits))
        close = F.bit_count(F.col("a").bitwiseXOR(F.col("bits"))) <= MOST_BITS
        found.append(
            probes.join(table, "key")
            .filter((F.col("a") < F.col("bits")) & close)
            .select("a", F.col("bits").alias("b"))
        )
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _by_neighbours(members: DataFrame, low: int, bits: int) -> DataFrame:
    """Links within crowded buckets; work is linear in the number of fingerprints.

    ``members`` (``a``, ``beside``, ``key``) are the fingerprints inside a crowded bucket,
    which agree in the segment, and those beside it, which differ there in one bit. Two
    inside are linked if they are within 4 of the other bits; this is so exactly if some
    number is within 2 bits of both. One inside and one beside are linked if they are
    within 3; this is so exactly if some number is within 2 bits of the first and 1 of the
    second. So each member is sent to all numbers that near; all that meet at a number are
    linked to the smallest member inside that is there.
    """
    others = [1 << b for b in range(64) if not low <= b < low + bits]
    pairs = [x | y for i, x in enumerate(others) for y in others[i + 1 :]]
    near = [0, *others]
    outside = _signed(~(((1 << bits) - 1) << low) & (1 << 64) - 1)
    balls = F.when(F.col("beside"), F.array(*(F.lit(_signed(m)) for m in near))).otherwise(
        F.array(*(F.lit(_signed(m)) for m in near + pairs))
    )
    met = members.select("a", "beside", "key", F.explode(balls).alias("flip")).select(
        "a", "beside", "key", F.col("a").bitwiseXOR(F.col("flip")).bitwiseAND(F.lit(outside)).alias("at")
    )
    least = met.groupBy("key", "at").agg(F.min(F.when(~F.col("beside"), F.col("a"))).alias("b"))
    return (
        met.select("a", "key", "at").join(least, ["key", "at"])
        .filter(F.col("a") != F.col("b"))
        .select("a", "b")
        .distinct()
    )


def _rooted(named: DataFrame) -> DataFrame:
    """A stored table of distinct ``bits`` with the ``root`` of each one's group."""
    found = components(links(named.select("bits")))
    return named.join(
        found.select(F.col("node").alias("bits"), F.col("component").alias("root")), "bits", "left"
    ).withColumn("root", F.coalesce("root", "bits"))


def near_copies(documents: DataFrame) -> DataFrame:
    """Per document its ``bits`` (signed fingerprint) and ``component``.

    Documents whose fingerprints are 4 or fewer bits apart are linked; ``component`` is
    the smallest ``doc_id`` that links reach. Copies are one fingerprint from the start,
    so a group of copies is one row to everything that follows. One row per input row,
    repeated rows included; null ids belong to their group but do not name it. Null and
    blank texts have fingerprint 0 and are linked like others. An empty table gives an
    empty result.
    """
    bounded_batches(documents.sparkSession)
    rows = session.store(documents.select("doc_id", fingerprinted(F.col("text")).alias("bits")))
    named = session.store(rows.groupBy("bits").agg(F.min("doc_id").alias("first")))
    reached = _rooted(named)
    smallest = reached.groupBy("root").agg(F.min("first").alias("component"))
    members = reached.join(smallest, "root").select("bits", "component")
    # a fingerprint may hold a third of the rows, so its rows stay in place where it can be sent
    return rows.join(members, "bits")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``."""
    return near_copies(documents).select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def representatives(documents: DataFrame) -> DataFrame:
    """One document of each group of near copies, all columns as they were.

    The one with the group's smallest id stays, null last; of different texts with that id
    the one with the smallest digest, of rows that repeat id and text one. Rows with a null
    id in a group with ids go; each group of null ids keeps one row.
    """
    bounded_batches(documents.sparkSession)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    rows = session.store(
        documents.select("doc_id", digest, fingerprinted(F.col("text")).alias("bits"))
    )
    age = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    named = session.store(rows.groupBy("bits").agg(F.min(age).alias("first")))
    # id and digest fix the text and so the group: they are one row per group
    kept = _rooted(named).groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("kept_id"), F.col("first.digest").alias("kept_digest")
    )
    whole = documents.select(F.struct("*").alias("doc"), F.col("doc_id"), digest)
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    one = whole.join(kept, same, "left_semi")
    return one.dropDuplicates(["doc_id", "digest"]).select("doc.*")

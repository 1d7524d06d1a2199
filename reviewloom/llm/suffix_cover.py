"""Exact repeats by the distributed difference cover: every step is a Spark sort or join.

A suffix is a row of (document, place). Rows whose place is 1 or 2 modulo 3 are the sample:
their triples of letters are sorted and named, and the names are the letters of a string two
thirds as long, whose suffixes are ranked the same way. The other suffixes are merged in by
two more sorts. Adjacent suffixes are compared byte by byte, also across partition borders.

Every letter costs several shuffled rows, many times the bytes of the text;
``repeats.without_repeats`` gives the same result at a fraction of that. The README has the
figures of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.llm.anchors import LENGTH
from reviewloom.llm.common import bounded_batches
from reviewloom.llm.repeats import DOC, _firsts, _identity, _merged

# Names of so many nested triples cover more bytes than are ever compared.
DEPTH = 5
# Letters of one string that are handled in one window: a long text is work for many tasks.
BLOCK = 1 << 12

_PLACE = ["number", "at"]
# What the places in ``cuts`` are given in: the byte, and one window.
_WINDOW_BITS = 7


def _sample_sizes(size: Column) -> tuple[Column, Column]:
    """How many of ``size`` places are 1 and 2 modulo 3. A string whose last place is 0
    modulo 3 has one more, behind its end, so that no triple runs on into the second part."""
    odd_end = (size % 3 == 1).cast("int")
    return F.floor((size + odd_end + 1) / 3).cast("int"), F.floor(size / 3).cast("int")


def _size(level: int) -> Column:
    """The letters of a document's string at a level of the recursion."""
    size = F.col("length")
    for _ in range(level):
        ones, twos = _sample_sizes(size)
        size = ones + twos
    return size


def _before(order: list[str], same: list[str]):
    """A function over sorted partitions: how much ``weight`` lies before each row's group,
    within the partition. Rows that follow each other with equal ``same`` are a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, base, total, head = None, 0, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(name) for name in same]
            values = [c.to_numpy(zero_copy_only=False) for c in columns]
            new = _firsts(*values)
            new[0] = last is None or tuple(v[0] for v in values) != last
            weight = batch.column("weight").to_numpy()
            earlier = total + np.cumsum(weight) - weight
            at = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            before = np.where(at >= 0, earlier[at], base)
            heads = np.full(len(new), head)
            begins = np.flatnonzero(new)
            if len(begins) and last is not None:
                heads[begins[0] :] = False
            elif len(begins) > 1:
                heads[begins[1] :] = False
            head, base = bool(heads[-1]), int(before[-1])
            total += int(weight.sum())
            last = tuple(v[-1] for v in values)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(len(new), part, np.int32)),
                    pa.array(before.astype(np.int64)),
                    pa.array(heads),
                ],
                names=[*batch.schema.names, "part", "inside", "head"],
            )

    return run


def ranked(frame: DataFrame, order: list[str], same: list[str]) -> DataFrame:
    """``frame`` with ``before``: the ``weight`` of all rows of smaller groups.

    Rows are sorted by ``order`` over all partitions, place last, so equal keys may spread
    over many of them. A group is rows in a row with equal ``same``; where it goes on
    across a border, its rows there get what its first row has. One short row per
    partition is gathered for that.
    """
    names = [f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields]
    found = session.store(
        frame.orderBy(*order, *_PLACE).mapInArrow(
            _before(order, same), ", ".join([*names, "part int", "inside bigint", "head boolean"])
        )
    )
    ends = found.groupBy("part").agg(
        F.sum("weight").alias("total"),
        F.max("inside").alias("last_base"),
        F.min_by(F.struct(*same), F.struct(*order, *_PLACE)).alias("first_key"),
        F.max_by(F.struct(*same), F.struct(*order, *_PLACE)).alias("last_key"),
        F.bool_and("head").alias("one_group"),
    )
    borders, offset, base, key = [], 0, 0, None
    for row in sorted(ends.collect(), key=lambda r: r["part"]):
        goes_on = key is not None and row["first_key"] == key
        borders.append((row["part"], offset, base if goes_on else offset))
        if not (goes_on and row["one_group"]):
            base = offset + row["last_base"]
        offset, key = offset + row["total"], row["last_key"]
    spark = frame.sparkSession
    table = spark.createDataFrame(borders, "part int, offset bigint, head_base bigint")
    before = F.when(F.col("head"), F.col("head_base")).otherwise(F.col("offset") + F.col("inside"))
    return found.join(F.broadcast(table), "part").select(*frame.columns, before.alias("before"))


def _first_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every place of each text with its three bytes, counted from 1; 0 is past the end."""
    for batch in batches:
        for number, text in zip(batch.column("number").to_pylist(), batch.column("text").to_pylist()):
            data = np.frombuffer(text.encode(), np.uint8)
            size = len(data)
            places = size + (size % 3 == 1)
            letters = np.concatenate([data.astype(np.int64) + 1, np.zeros(3, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(places, number, np.int64)),
                    pa.array(np.arange(places, dtype=np.int32)),
                    pa.array(np.full(places, size, np.int32)),
                    *(pa.array(letters[i : places + i]) for i in range(3)),
                ],
                names=["number", "at", "length", "a", "b", "c"],
            )


def _triples(letters: DataFrame, level: int) -> DataFrame:
    """Each place of the strings with its letter and the two after it.

    Strings are cut into blocks, and a block also gets the two letters that follow it.
    """
    end = letters.filter((F.col("at") == _size(level) - 1) & (_size(level) % 3 == 1))
    behind = end.withColumns({"at": F.col("at") + 1, "letter": F.lit(0).cast("bigint")})
    block = F.floor(F.col("at") / BLOCK)
    blocks = F.when((F.col("at") % BLOCK < 2) & (block > 0), F.array(block, block - 1))
    dealt = letters.unionByName(behind).withColumn(
        "block", F.explode(F.coalesce(blocks, F.array(block)))
    )
    in_block = "PARTITION BY number, block ORDER BY at"
    return (
        dealt.withColumns(
            {
                "b": F.expr(f"lead(letter, 1, 0L) OVER ({in_block})"),
                "c": F.expr(f"lead(letter, 2, 0L) OVER ({in_block})"),
            }
        )
        .filter(F.col("block") == block)
        .select("number", "at", "length", F.col("letter").alias("a"), "b", "c")
    )


def suffix_ranks(triples: DataFrame, depth: int = DEPTH, level: int = 0) -> DataFrame:
    """``number``, ``at``, ``length`` and ``rank``, which puts the suffixes in order.

    Suffixes that are equal, or share 3 ** ``depth`` letters, come in any order or as one.
    """
    triples = session.store(triples)
    size, kind = _size(level), F.col("at") % 3
    names = ranked(
        triples.filter(kind != 0).withColumn("weight", F.lit(1)), ["a", "b", "c"], ["a", "b", "c"]
    ).select("number", "at", "length", (F.col("before") + 1).alias("letter"))
    if depth == 1:
        ranks = names.withColumnRenamed("letter", "rank")
    else:
        ones, _ = _sample_sizes(size)
        third = F.floor(F.col("at") / 3).cast("int")
        string = names.withColumn("at", F.when(kind == 1, third).otherwise(ones + third))
        back = F.when(F.col("at") < ones, F.col("at") * 3 + 1).otherwise((F.col("at") - ones) * 3 + 2)
        ranks = suffix_ranks(_triples(string, level + 1), depth - 1, level + 1).withColumn(
            "at", back.cast("int")
        )
    # each place with its own rank and those of the one and two places after it
    none = F.lit(None).cast("bigint")
    given = F.explode(
        F.array(
            *(
                F.struct(
                    (F.col("at") - i).cast("int").alias("at"),
                    *(F.when(F.lit(i == j), F.col("rank")).alias(f"r{j}") for j in range(3)),
                )
                for i in range(3)
            )
        )
    )
    told = ranks.select("number", "length", given.alias("g")).select(
        "number", "length", "g.at", none.alias("a"), none.alias("b"), "g.r0", "g.r1", "g.r2"
    )
    own = triples.select("number", "length", "at", "a", "b", *(none.alias(f"r{j}") for j in range(3)))
    zero = F.lit(0).cast("bigint")
    places = session.store(
        own.unionByName(told)
        .filter("at >= 0")
        .groupBy("number", "at", "length")
        .agg(*(F.coalesce(F.max(c), zero).alias(c) for c in ("a", "b", "r0", "r1", "r2")))
    )

    def smaller(sample: int, keys: list[str]) -> DataFrame:
        """Of the suffixes at 0 modulo 3: how many of one part of the sample are smaller."""
        both = places.filter(kind.isin(0, sample)).select(
            *_PLACE, *keys, (kind == sample).cast("int").alias("weight")
        )
        return ranked(both, keys, keys).filter(kind == 0).select(
            *_PLACE, F.col("before").alias(f"before_{sample}")
        )

    merged = (
        places.filter(kind == 0)
        .join(smaller(1, ["a", "r1"]), _PLACE)
        .join(smaller(2, ["a", "b", "r2"]), _PLACE)
        .select(
            *_PLACE, "length", (F.col("before_1") + F.col("before_2")).alias("k0"),
            zero.alias("k1"), F.col("a").alias("k2"), F.col("r1").alias("k3"),
        )
    )
    sample = places.filter(kind != 0).select(
        *_PLACE, "length", (F.col("r0") - 1).alias("k0"), (zero + 1).alias("k1"),
        zero.alias("k2"), zero.alias("k3"),
    )
    keys = ["k0", "k1", "k2", "k3"]
    everything = merged.unionByName(sample).filter(F.col("at") < size)
    return ranked(everything.withColumn("weight", F.lit(1)), keys, keys).select(
        *_PLACE, "length", (F.col("before") + 1).alias("rank")
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of every window of each text."""
    for batch in batches:
        for number, text in zip(batch.column("number").to_pylist(), batch.column("text").to_pylist()):
            data = text.encode()
            for begin in range(0, len(data) - LENGTH + 1, 1 << 16):
                places = range(begin, min(begin + (1 << 16), len(data) - LENGTH + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(places), number, np.int64)),
                        pa.array(np.arange(places.start, places.stop, dtype=np.int32)),
                        pa.array([data[i : i + LENGTH] for i in places], pa.binary()),
                    ],
                    names=["number", "at", "prefix"],
                )


def removed_ranges(documents: DataFrame) -> DataFrame:
    """Per document (``doc``, ``high``, ``low``) with repeats the byte ranges to remove (``cuts``).

    The same result as ``repeats.removed_ranges``, with the same order of documents: null
    ids last, repeated rows one document. Null and short texts have no windows; an empty
    table gives an empty result; other columns are not read.
    """
    bounded_batches(documents.sparkSession)
    # order keeps: the number grows with the document's place in it
    texts = session.store(
        documents.select(*_identity())
        .filter(F.octet_length("text") >= LENGTH)
        .dropDuplicates(list(DOC))
        .orderBy(*DOC)
        .withColumn("number", F.monotonically_increasing_id())
    )
    if texts.isEmpty():  # no text is as long as a window
        return texts.select(*DOC, F.array().cast("array<bigint>").alias("cuts"))
    words = texts.select("number", "text")
    triple = "number bigint, at int, length int, a bigint, b bigint, c bigint"
    ranks = suffix_ranks(words.mapInArrow(_first_triples, triple))
    windows = words.mapInArrow(_prefixes, "number bigint, at int, prefix binary")
    adjacent = ranks.join(windows, _PLACE).select(
        *_PLACE, "rank", "prefix", F.lit(1).alias("weight")
    )
    groups = session.store(
        ranked(adjacent, ["rank"], ["prefix"]).select(*_PLACE, F.col("before").alias("of"))
    )
    oldest = groups.groupBy("of").agg(
        F.min(F.struct(*_PLACE)).alias("oldest"), F.count(F.lit(1)).alias("n")
    )
    later = groups.join(oldest.filter("n > 1"), "of").filter(F.struct(*_PLACE) != F.col("oldest"))
    one = F.shiftleft(F.col("at").cast("bigint"), _WINDOW_BITS) + 1
    return (
        later.groupBy("number")
        .agg(F.collect_list(one).alias("ats"))
        .join(texts.drop("text"), "number")
        .select(*DOC, F.pandas_udf(_merged, "array<bigint>")("ats").alias("cuts"))
    )

"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import WORD

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
# No document is taken more often.
MOST_COPIES = 3
# How each source's weight changes in training, repeating like the weights: multiples of
# its weight at evenly spaced times from begin to end, linear between them.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
# A source's documents are ordered by digest and summed up in this many ranges of the
# digest, so that one source is work for many tasks.
RANGES = 4096

_LONG = "bigint"


def n_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast(_LONG)


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """Per source (``source``, ``source_size``) its ``target`` and ``place`` in the weights.

    All sizes together are shared by weight; no target is above ``most`` times its
    source's size, what is cut off being shared among the others by weight. A source is
    cut when raising all targets in step to its limit would not use up the total. One row
    per source passes through one task, no row per document.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = Window.orderBy(F.col("source").isNull(), "source")
    filled = Window.orderBy("level", F.col("source").isNull(), "source")
    ranked = sizes.withColumn(
        "place", F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))).cast("int")
    )
    weighed = (
        ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") + 1))
        .withColumn("limit", F.col("source_size") * most)
        .withColumn("level", F.col("limit") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("open", F.sum("weight").over(filled.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "used", F.sum("limit").over(filled.rowsBetween(Window.unboundedPreceding, 0))
        )
        .withColumn("used", F.col("used") - F.col("limit"))
    )
    cut = F.col("used") + F.col("level") * F.col("open") < F.col("total")
    shared = F.sum(F.when(~cut, F.col("weight"))).over(everything)
    left = F.col("total") - F.coalesce(
        F.sum(F.when(cut, F.col("limit"))).over(everything), F.lit(0)
    )
    target = F.when(cut, F.col("limit").cast("double")).otherwise(
        F.col("weight") * left.cast("double") / shared
    )
    return weighed.withColumn("cut", cut).select("source", "source_size", "place", target.alias("target"))


def training_time(share: Column, values: Sequence[float]) -> Column:
    """When a source has spent ``share`` of its tokens: its integrated schedule, inverted."""
    areas = [(a + b) / 2 for a, b in zip(values, values[1:])]
    whole, pieces, before = sum(areas), len(areas), 0.0
    found = None
    for i, area in enumerate(areas):
        a, b = values[i], values[i + 1]
        rest = share * whole - before
        root = a + F.sqrt(F.greatest(F.lit(a * a) + 2 * (b - a) * rest, F.lit(0.0)))
        at = (F.lit(float(i)) + F.coalesce(2 * rest / F.nullif(root, F.lit(0.0)), F.lit(0.0))) / pieces
        before += area
        found = F.when(share * whole <= before, at) if found is None else found.when(share * whole <= before, at)
    return F.least(found.otherwise(F.lit(1.0)), F.lit(1.0))


def mixed(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    schedules: Sequence[Sequence[float]] = SCHEDULES,
    most: int = MOST_COPIES,
    carried: Sequence[str] | None = None,
) -> DataFrame:
    """Each document's share of the mix.

    Columns: ``doc`` (the input row, or its ``carried`` columns, as a struct), ``size``,
    ``source_size``, ``target``, ``copies``, ``taken`` (words, repeats counted) and
    ``before`` (words of the source before it). A source is read in order of a digest of
    ``doc_id`` and text, which spreads documents that share an id, as often as its target goes into its size; the last reading ends at the
    document that crosses the target, which is taken if its middle lies before it.

    One row per input row: repeated rows count as rows of their own, null ids and sources
    are values like others (null last), null and empty texts have size 0. An empty table
    gives an empty result.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    digest = F.md5(F.concat(name, F.lit(":"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    rows = documents.select(
        F.struct(*(["*"] if carried is None else carried)).alias("doc"), "source", n_words().alias("size"), digest.alias("digest")
    ).withColumn("range", F.conv(F.substring("digest", 1, 3), 16, 10).cast("int"))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    sources = targets(
        sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most
    )
    earlier = Window.partitionBy("source").orderBy("range")
    offsets = sums.select(
        "source", "range", (F.sum("words").over(earlier) - F.col("words")).alias("offset")
    )
    plan = offsets.join(
        sources, offsets["source"].eqNullSafe(sources["source"])
    ).select(offsets["source"].alias("of"), offsets["range"].alias("in"), "offset", "source_size", "place", "target")
    within = Window.partitionBy("source", "range").orderBy("digest", "doc.doc_id", "size")
    summed = rows.withColumn("upto", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    joined = summed.join(
        plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in"))
    )
    whole = F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))
    whole = F.least(F.coalesce(whole, F.lit(0)), F.lit(most)).cast(_LONG)
    rest = F.col("target") - whole * F.col("source_size")
    crosses = F.col("before") + F.col("size") / 2 < rest
    return (
        joined.withColumn("before", F.col("offset") + F.col("upto") - F.col("size"))
        .withColumn("copies", F.least(whole + crosses.cast(_LONG), F.lit(most).cast(_LONG)))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("position", _position(F.lit(0), schedules))
        .select("doc", "size", "source_size", "target", "copies", "taken", "before", "place", "position")
    )


def _position(copy: Column, schedules: Sequence[Sequence[float]]) -> Column:
    """Training time from 0 to 1 of a copy, null for documents that are not taken."""
    spent = copy * F.col("source_size") + F.col("before") + F.col("size") / 2
    share = spent / F.nullif(F.col("target"), F.lit(0.0))
    by_place = [
        F.when(F.pmod(F.col("place"), F.lit(len(schedules))) == i, training_time(share, values))
        for i, values in enumerate(schedules)
    ]
    return F.when(F.col("copies") > 0, F.coalesce(*by_place, F.lit(0.0)))


def mix(documents: DataFrame) -> DataFrame:
    """One row per document in training order: its size, its source's, and what is taken.

    ``position`` is when its first copy is seen, null where none is. See ``mixed``.
    """
    return (
        mixed(documents, carried=["doc_id"])
        .select("doc.doc_id", "size", "source_size", "target", "taken", "position")
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


def training_set(
    documents: DataFrame, schedules: Sequence[Sequence[float]] = SCHEDULES
) -> DataFrame:
    """The documents the mix takes, once per copy, in training order, columns as they were.

    Ties in position are ordered by id, null first, and text. Null and empty texts are not
    taken, having no words; repeated rows count as rows of their own; columns of any name are
    returned. An empty table gives an empty result.
    """
    copies = mixed(documents, schedules=schedules).filter("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast(_LONG), F.col("copies") - 1))
    )
    return (
        copies.withColumn("position", _position(F.col("copy"), schedules))
        .orderBy("position", "doc.doc_id", F.xxhash64("doc.text"), "copy")
        .select("doc.*")
    )

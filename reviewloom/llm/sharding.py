"""Sharding by a k-d tree over metadata. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.operators import joins, sizing

SHARDS = 16

# A row's order in a dimension is a number of 63 bits: 20 of the dimension, 19 of the
# text's checksum, so that copies lie together, 24 of a hash that tells copies apart.
_DIMENSION_BITS, _TEXT_BITS, _ID_BITS = 20, 19, 24
_BITS = _DIMENSION_BITS + _TEXT_BITS + _ID_BITS
# A median is found digit by digit; a digit has this many bits, so each step gathers at
# most 2 ** 13 sums per node of the tree. Three digits tell texts apart, the others copies.
_DIGIT = 13
# The search ends when the digit that holds the median is lighter than this part of a node.
FINE = 1 / 4096
# Equal texts up to this part of a shard's bytes are not cut; the cut goes to the nearer side
# of them, so no shard is off by more than this part.
WHOLE = 1 / 32
# Rows of a shard are numbered in this many ranges of a hash, in parallel.
RANGES_BITS = 12


class Split(NamedTuple):
    """Rows whose order in ``dimension`` is below ``cut`` go left."""

    dimension: str
    cut: int
    left: int
    right: int


def _ranked(documents: DataFrame, column: str) -> DataFrame:
    """The distinct values of ``column`` as text, each with its ``rank`` from 0; stored.

    Spark sorts them in ranges; a range's first rank is the number of values before it. One
    row per range comes to the driver.
    """
    value = F.col(column).cast("string").alias("value")
    values = documents.select(value).filter("value IS NOT NULL").distinct()
    # numbered within their range, in order; the range is in the upper bits
    placed = session.store(values.orderBy("value").withColumn("at", F.monotonically_increasing_id()))
    ranges = placed.groupBy(F.shiftright("at", 33).alias("range")).count().orderBy("range").collect()
    before, first = 0, []
    for row in ranges:
        first += [F.lit(row["range"]), F.lit(before)]
        before += row["count"]
    if not first:
        return placed.select("value", F.col("at").alias("rank"))
    start = F.element_at(F.create_map(*first), F.shiftright("at", 33))
    return placed.select("value", (start + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank"))


def _with_rank(rows: DataFrame, ranks: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the rank of ``column`` as ``name``; null is last.

    The values are sent to the rows where they are measured to be few; else rows are joined
    with the hot values spread.
    """
    keyed = rows.withColumn("value", F.col(column).cast("string"))
    if sizing.is_small(ranks):
        found = keyed.join(F.broadcast(ranks), "value", "left")
    else:
        found = joins.salted_join(keyed, ranks, "value", "left")
    return found.withColumn(name, F.coalesce("rank", F.lit(ranks.count())).cast("double")).drop("value", "rank")


def _together(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` in which equal texts have one source and one language for the tree, the first
    ones of the group, so that they are neighbours in every dimension.

    Only groups that can stay whole are joined back, so no key of the join is hot; heavier
    ones are cut by their rows' own sources and languages. Texts are compared by a 64-bit
    hash, as a collision does no more than put two texts side by side.
    """
    places, seen = ("by_source", "by_lang"), Observation()
    groups = rows.groupBy("text_hash").agg(
        *(F.min(p).alias(f"first_{p}") for p in places),
        F.count(F.lit(1)).alias("copies"),
        F.sum("size").alias("weight"),
    )
    groups = groups.observe(seen, F.sum("weight").alias("total")).filter("copies > 1")
    groups = session.store(groups.drop("copies"))
    most = WHOLE * (seen.get["total"] or 0) / shards
    groups = groups.filter(F.col("weight") <= most).drop("weight")
    if sizing.is_small(groups):
        found = rows.join(F.broadcast(groups), "text_hash", "left")
    else:
        found = joins.salted_join(rows, groups, "text_hash", "left")
    found = found.withColumns({p: F.coalesce(f"first_{p}", p) for p in places})
    return found.drop("text_hash", *(f"first_{p}" for p in places))


def measured(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc`` (the input row as a struct) with what the tree needs to know of it.

    ``hash`` differs between rows that repeat an id and a text too, by their place in the
    input, so that a cut can pass between them: ``documents`` should be a stored table, which
    gives a row the same place whenever it is read.
    """
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text).cast("bigint") + 1).alias("size")
    rows = documents.select(
        F.struct("*").alias("doc"),
        size,
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.select(
        "doc",
        "size",
        "text_crc32",
        "text_hash",
        F.xxhash64("doc.doc_id", "text_crc32", "row").alias("hash"),
        F.log2("size").alias("by_size"),
    )
    for column in ("source", "lang"):
        rows = _with_rank(rows, _ranked(documents, column), f"doc.{column}", f"by_{column}")
    return _together(rows, shards)


DIMENSIONS = ("by_source", "by_lang", "by_size")


def _order(dimension: str, low: float, high: float) -> Column:
    steps = (1 << _DIMENSION_BITS) - 1
    scaled = (F.col(dimension) - low) / ((high - low) or 1.0) * steps
    step = F.least(F.greatest(F.floor(scaled), F.lit(0)), F.lit(steps)).cast("bigint")
    text = F.shiftright("text_crc32", 32 - _TEXT_BITS)
    own = F.shiftrightunsigned("hash", 64 - _ID_BITS)
    return (
        F.shiftleft(step, _TEXT_BITS + _ID_BITS)
        .bitwiseOR(F.shiftleft(text, _ID_BITS))
        .bitwiseOR(own)
    )


class Tree(NamedTuple):
    """The splits by node; ``leaves`` maps a node without one to its shard."""

    orders: dict[str, tuple[float, float]]
    splits: dict[int, Split]
    leaves: dict[int, int]

    def _below(self, node: int, value_of: Callable[[int], Column]) -> Column:
        if node not in self.splits:
            return value_of(node)
        split = self.splits[node]
        return F.when(
            F.col(f"order_{split.dimension}") < split.cut, self._below(split.left, value_of)
        ).otherwise(self._below(split.right, value_of))

    def node(self) -> Column:
        """Where a row with order columns has come to so far."""
        return self._below(0, F.lit)

    def shard(self) -> Column:
        return self._below(0, lambda node: F.lit(self.leaves[node]))

    def with_orders(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({f"order_{d}": _order(d, *self.orders[d]) for d in DIMENSIONS})


def _medians(rows: DataFrame, wanted: dict[int, tuple[str, float, float, float]]) -> dict[int, int]:
    """Per node the order value that splits its weight at the wanted weight.

    ``rows`` has ``node``, ``size`` and one order column per dimension; ``wanted`` gives
    the dimension, the weight to put left, the node's weight and up to which weight equal
    texts stay whole. Each step sums the next digit of the rows that share the digits found
    so far; one row per node returns.
    """
    order = F.coalesce(
        *(F.when(F.col("node") == n, F.col(d)) for n, (d, *_) in wanted.items())
    )
    keyed = rows.withColumn("order", order).filter(F.col("order").isNotNull())
    prefix, before, cuts, shift = dict.fromkeys(wanted, 0), dict.fromkeys(wanted, 0), {}, _BITS
    while len(cuts) < len(wanted):
        digit = min(_DIGIT, shift)
        open_nodes = [n for n in wanted if n not in cuts]
        # shiftright by 63 and more would wrap round
        high = F.shiftright("order", shift) if shift < _BITS else F.lit(0).cast("bigint")
        shift -= digit
        same = F.coalesce(*(F.when(F.col("node") == n, high == prefix[n]) for n in open_nodes))
        goal = F.coalesce(
            *(F.when(F.col("node") == n, F.lit(wanted[n][1] - before[n])) for n in open_nodes)
        )
        sums = (
            keyed.filter(same)
            .groupBy("node", F.shiftright("order", shift).alias("digits"))
            .agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("n"))
        )
        upto = Window.partitionBy("node").orderBy("digits")
        crossing = (
            sums.withColumn("upto", F.sum("weight").over(upto))
            .filter((F.col("upto") >= goal) & (F.col("upto") - F.col("weight") < goal))
            .collect()
        )
        for row in crossing:
            node, (_, goal_weight, whole, text) = row["node"], wanted[row["node"]]
            below = before[node] + row["upto"] - row["weight"]
            most = max(text, FINE * whole) if shift == _ID_BITS else FINE * whole
            if row["n"] == 1 or row["weight"] <= most or not shift:
                # the cut goes to the nearer edge of the digit
                above = below + row["weight"] - goal_weight > goal_weight - below
                cuts[node] = (row["digits"] + (not above)) << shift
            prefix[node], before[node] = row["digits"], below
        for node in set(open_nodes) - {row["node"] for row in crossing}:
            cuts[node] = 0  # an empty node
    return cuts


def _moments(dimension: str, low: float, high: float) -> list[Column]:
    """Mean and mean square by bytes, with the range from ``low`` to ``high`` as unit."""
    at = (F.col(dimension) - low) / ((high - low) or 1.0)
    return [
        (F.sum(F.col("size") * power) / F.sum("size")).alias(f"{name}_{dimension}")
        for name, power in (("mean", at), ("square", at * at))
    ]


def grow(rows: DataFrame, shards: int = SHARDS) -> Tree:
    """Split at weighted medians along the widest dimension until each leaf is one shard.

    A node's width is its variance by bytes, with the whole table's range as unit, so that one
    far-off row makes no dimension wide.

    A leaf's target is the total weight over ``shards``; a node of k leaves is split in
    the proportion of their halves. What returns to the driver is a row per node and step,
    so it is bounded by the number of shards.
    """
    spans = rows.agg(
        *(F.min(d).alias(f"low_{d}") for d in DIMENSIONS),
        *(F.max(d).alias(f"high_{d}") for d in DIMENSIONS),
    ).first()
    orders = {d: (spans[f"low_{d}"] or 0.0, spans[f"high_{d}"] or 0.0) for d in DIMENSIONS}
    tree, open_nodes = Tree(orders, {}, {}), {0: range(shards)}
    # stored, so that a filter on a node does not repeat the order's expression per split
    ordered = session.store(tree.with_orders(rows))
    while open_nodes:
        for node in [n for n, own in open_nodes.items() if len(own) == 1]:
            tree.leaves[node] = open_nodes.pop(node)[0]
        if not open_nodes:
            break
        placed = ordered.withColumn("node", tree.node())
        widths = {
            row["node"]: row
            for row in placed.groupBy("node")
            .agg(
                F.sum("size").alias("weight"),
                *(column for d in DIMENSIONS for column in _moments(d, *orders[d])),
            )
            .collect()
        }
        wanted = {}
        for node, own in open_nodes.items():
            width, weight = widths.get(node), 0
            dimension = DIMENSIONS[0]
            if width is not None:
                weight = width["weight"]
                dimension = max(
                    DIMENSIONS,
                    key=lambda d: round(width[f"square_{d}"] - width[f"mean_{d}"] ** 2, 9),
                )
            leaf = weight / len(own)
            wanted[node] = (f"order_{dimension}", leaf * (len(own) // 2), weight, WHOLE * leaf)
        cuts = _medians(placed, wanted)
        following = {}
        for node, own in open_nodes.items():
            half = len(own) // 2
            left, right = 2 * node + 1, 2 * node + 2
            dimension = wanted[node][0].removeprefix("order_")
            tree.splits[node] = Split(dimension, cuts[node], left, right)
            following |= {left: own[:half], right: own[half:]}
        open_nodes = following
    return tree


def sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc`` (the input row as a struct), ``size``, ``text_crc32``, ``shard``, ``slot``.

    Shards are nearly equal in bytes. Equal texts lie in one shard, whatever their sources and
    languages, but where they weigh more than ``WHOLE`` of a shard, so that a cut may pass
    between them. Slots count a shard's
    rows from 0. One row per input row: repeated rows and null ids are rows like others, a
    null text has no bytes. An empty table gives an empty result. ``documents`` should be a
    stored table, see ``measured``.
    """
    rows = measured(documents, shards)
    tree = grow(session.store(rows.drop("doc")), shards)
    placed = tree.with_orders(rows).select("doc", "size", "text_crc32", "hash", tree.shard().alias("shard"))
    placed = placed.withColumn("range", F.shiftrightunsigned("hash", 64 - RANGES_BITS))
    counts = placed.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("range")
    offsets = counts.select(
        F.col("shard").alias("of"),
        F.col("range").alias("in"),
        (F.sum("rows").over(earlier) - F.col("rows")).alias("offset"),
    )
    within = Window.partitionBy("shard", "range").orderBy("hash", "doc.doc_id", "text_crc32")
    numbered = placed.withColumn("number", F.row_number().over(within) - 1)
    # at most shards * 2 ** RANGES_BITS short rows
    return numbered.join(
        offsets, (F.col("shard") == F.col("of")) & (F.col("range") == F.col("in"))
    ).select(
        "doc", "size", "text_crc32", "shard", (F.col("offset") + F.col("number")).alias("slot")
    )


def shards_of(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: where it goes. See ``sharded``."""
    return sharded(documents, shards).select(
        "doc.doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with all columns, and ``shard`` and ``slot`` in place of any so named.

    Null, empty, repeated and clashing input: see ``sharded``.
    """
    kept = [c for c in documents.columns if c.lower() not in ("shard", "slot")]
    return sharded(documents, shards).select(
        *(F.col("doc").getField(c).alias(c) for c in kept), "shard", "slot"
    )

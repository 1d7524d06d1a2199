"""Connected components of a graph whose edges fit no single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom import session


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Per node of ``edges`` (``a``, ``b``, of one type) the smallest node it reaches.

    Columns ``node`` and ``component``. Large-star and small-star rounds: every node links
    its larger neighbours to its smallest one, then its smaller ones, until nothing
    changes, which takes a number of rounds logarithmic in the number of nodes. Each round
    is written to the scratch folder. Minima are combined before the shuffle and joined
    back, so a node with many neighbours is never gathered in one task.
    """
    pairs = session.store(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large-star: neighbours above a node, and the node's smallest neighbour or itself
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            both.join(least, "a")
            .filter(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        # small-star: neighbours below a node and the node itself, to the smallest of them
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(lowest, "a")
        small = (
            linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lowest.select("a", F.col("m").alias("b")))
            .filter("a != b")
            .distinct()
        )
        following = session.store(small)
        # both tables hold distinct rows: equal counts and no row that is missing
        if following.count() == pairs.count() and following.join(
            pairs, ["a", "b"], "left_anti"
        ).isEmpty():
            break
        pairs = following
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return (
        pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
        .unionByName(roots)
        .groupBy("node")
        .agg(F.min("component").alias("component"))
    )

"""The distributed difference cover against brute force and the operator's own result."""

import random

from reviewloom.llm import repeats, suffix_cover


def test_ranks_order_the_suffixes(spark, monkeypatch):
    monkeypatch.setattr(suffix_cover, "BLOCK", 2)
    rng = random.Random(5)
    texts = {n: "".join(rng.choice("ab") for _ in range(n % 23 + 1)) for n in range(30)}
    texts[30] = texts[31] = "a" * 40
    frame = spark.createDataFrame(list(texts.items()), "number bigint, text string")
    triples = frame.repartition(3).mapInArrow(
        suffix_cover._first_triples, "number bigint, at int, length int, a bigint, b bigint, c bigint"
    )
    ranks = sorted((r["rank"], r["number"], r["at"]) for r in suffix_cover.suffix_ranks(triples, 4).collect())
    assert {r[1:] for r in ranks} == {(n, i) for n, t in texts.items() for i in range(len(t))}
    suffixes = [texts[n][i:] for _, n, i in ranks]
    assert suffixes == sorted(suffixes)


def test_groups_go_on_across_borders(spark):
    rows = [(n, n % 7, 5 if n < 900 else n, 1) for n in range(1000)]
    frame = spark.createDataFrame(rows, "number bigint, at int, a bigint, weight int")
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["number"]: r["before"] for r in suffix_cover.ranked(frame, ["a"], ["a"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts)
    assert got == {n: 0 if n < 900 else n for n in range(1000)}


def test_removed_ranges_equal_the_operators(spark):
    rng = random.Random(11)
    passage = "".join(rng.choice("abcdé ") for _ in range(260))
    texts = [
        passage, "x" + passage + "y", passage, "z" * 350, passage[50:190], "short", "", None,
        "".join(rng.choice("ab") for _ in range(400)), passage[:99] + "#" + passage[99:],
    ]
    rows = [(n if n % 4 else None, t) for n, t in enumerate(texts)] + [(2, passage), (2, "other" + passage)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)

    def cuts(found):
        return {tuple(r)[:3]: r["cuts"] for r in found.collect()}

    got = cuts(suffix_cover.removed_ranges(frame))
    assert got == cuts(repeats.removed_ranges(frame)) and len(got) >= 6


def test_no_documents(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string, at string")
    assert suffix_cover.removed_ranges(frame).collect() == []

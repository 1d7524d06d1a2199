"""Exact duplicates against brute force."""

import collections
import hashlib
import random
import re

import pytest

from reviewloom import session
from reviewloom.llm import exact, queries

DOCS = "doc_id bigint, text string, digest string, holder int, n int, kept string"


def brute(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row[0])
    found = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, ids[0], len(ids), at == 0, sha) for at, i in enumerate(ids)]
    return collections.Counter(found)


@pytest.fixture(scope="module")
def copies(spark):
    """A third of the rows are one text; nulls, blanks, repeated and null ids, a long text."""
    rng = random.Random(2)
    texts = [f"text {rng.randrange(120)}" for _ in range(400)]
    texts = [t.replace(" ", rng.choice([" ", "\t", " \n\r ", "\x0b\x0c"])) for t in texts]
    texts += ["hot  text", "hot text", "hot\ntext"] * 70
    texts += [None, "", " ", "\n\n", " a", "a", "a ", "a b", "a b", "é" * 30000, "é" * 30000]
    rows = [(i, t, "x", 1, 2, "k") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    rows += [rows[0], rows[0], (None, "only null ids", "y", 0, 0, "")]
    rows += [(None, "only null ids", "y", 0, 0, ""), (None, "hot text", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(7), rows


@pytest.mark.parametrize("fan, held", [(16, 10_000), (2, 10), (3, 5)])
def test_duplicates(copies, fan, held):
    frame, rows = copies
    found = exact.duplicates(frame, fan, held)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(map(tuple, found.collect())) == brute(rows)


def test_runs_longer_than_a_batch(spark, copies):
    frame, rows = copies
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        found = exact.duplicates(frame, 2, 100).collect()
    finally:
        spark.conf.set(name, before)
    assert collections.Counter(map(tuple, found)) == brute(rows)


def test_levels():
    assert exact.levels_for(0) == 1
    assert exact.levels_for(160_000) == 1
    assert exact.levels_for(160_001) == 2
    assert exact.levels_for(9, fan=2, held=1) == 4


def test_each_level_has_one_entry_per_text_and_holder(spark, copies):
    """A group of copies is combined before it is exchanged, and digests that meet are
    kept apart if the SHA-256 differs."""
    frame, rows = copies
    same = exact._digested(frame).selectExpr("doc_id", "row", "digest % 3 AS digest", "sha256")
    stored = session.store(same)
    merged = exact.tree_merge(stored, levels=3, fan=2).collect()
    assert len({bytes(r["sha256"]) for r in merged}) == len(merged) == len({k[4] for k in brute(rows)})
    assert sum(r["n"] for r in merged) == len(rows)


def test_without_copies(copies):
    frame, rows = copies
    kept = exact.without_copies(frame)
    assert kept.columns == frame.columns
    wanted = sorted((k[0] is None, k[0], k[4]) for k in brute(rows) if k[3])
    got = [
        (r["doc_id"] is None, r["doc_id"], hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "").encode()).hexdigest())
        for r in kept.collect()
    ]
    assert sorted(got) == wanted


def test_empty(spark):
    none = spark.createDataFrame([], DOCS)
    assert exact.duplicates(none).collect() == []
    assert exact.without_copies(none).collect() == []


def test_query_is_its_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    wanted = base.execute(queries.SQL["op13_exact_dedup"]).fetchall()
    got = queries.QUERIES["op13_exact_dedup"](spark, folder).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(wanted)

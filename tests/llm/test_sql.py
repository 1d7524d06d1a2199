"""The operators' queries against their SQL on the smallest tables."""

import glob
import os
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SMALL
from reviewloom.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def assert_equal(frame, expected):
    columns = sorted(frame.columns)
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in expected.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, oracle, name):
    assert_equal(QUERIES[name](spark, SMALL), oracle.sql(SQL[name]))


@pytest.mark.parametrize("name", ["op1_secret_scan", "op6_quality_rules", "op11_spelling_variants"])
def test_query_equals_its_sql_on_odd_texts(spark, tmp_path, name):
    """Nulls, blanks of every kind, repeats, short and long secrets, letters beyond ASCII."""
    rng = random.Random(11)
    parts = [
        "token=", "Secret: '", "abcdef0123456789", "AKIA", "ABCD1234EFGH5678", "é", "𝛼", "\t", "\n", "\x0b", "\x85", "\u00a0",
        "ghp_" + "a1B2" * 9, "xoxb-", "12345-abcde-12345-abcde", "eyJa.eyJb.c", "passwd", "paſſwd=abcdefghijklm", "#*|",
        "straße", "Éclairs", "éclairs", "voyages", "voyage", "VOYAGES", "voyagers", "same words again and again here",
    ]
    text = lambda n: "".join(rng.choice(parts) + rng.choice([" ", " ", "\n", ""]) for _ in range(n))
    texts = [None, "", " \n\t", "\n\n", "one", "voyages " * 30 + "voyage", *(text(rng.randint(1, 80)) for _ in range(150))]
    texts += [" ".join(f"w{i}" for i in range(60)), "a line of words\n" * 3 + " ".join(f"w{i}" for i in range(60))]
    # around the limit of five-word windows: a phrase of five among more and more words
    letters = "a b c d e f g h i j k l m n o p q r s t u v w x y z a b c d e "
    texts += [letters + " ".join(f"{i:02}" for i in range(n)) for n in range(19, 60)]
    ids = [*range(len(texts)), 6, 6, None]
    more = {"text": [*texts, texts[6], text(60), texts[8]], "word": [1] * len(ids), "n": ["x"] * len(ids)}
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), **more})
    pq.write_table(table, f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.register("documents", table)
    assert_equal(QUERIES[name](spark, str(tmp_path)), connection.sql(SQL[name]))

"""Every catalog query against its SQL statement, and the plans of the heavy ones."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from conftest import SMALL
from reviewloom.catalog.oracle import SQL
from reviewloom.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


# Row-at-a-time Python and all-pairs joins have no place in any plan.
BANNED = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    expected = oracle.sql(SQL[name])
    assert sorted(expected.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in expected.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    assert got == want
    plan = frame._jdf.queryExecution().toString()
    assert not [operator for operator in BANNED if operator in plan]


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_the_driver_sees_every_query():
    assert QUERIES.items() <= driver.queries().items()
    assert SQL.items() <= driver.oracle_sql().items()


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0

"""Reducing rows by a bitmap of key hashes."""

import pytest

from reviewloom.operators import bitmaps, merge


def test_maps_follow_the_number_of_keys():
    assert bitmaps.maps_for(0) == 1
    assert bitmaps.maps_for(4096) == 1
    assert bitmaps.maps_for(4097) == 2
    assert bitmaps.maps_for(10**12) == 0
    assert bitmaps.maps_for(5000, limit=bitmaps.ROW) == 0


@pytest.mark.parametrize("number", [0, 1, 700, 20_000])
def test_no_partner_is_lost_and_few_others_pass(spark, number):
    keys = spark.range(number).selectExpr("cast(id AS string) AS id")
    frame = spark.range(100_000).selectExpr("cast(id AS string) AS id", "id AS value").union(
        spark.createDataFrame([(None, 1)], "id string, value long")
    )
    found = bitmaps.likely_rows(frame, keys, "id")
    assert found.columns == frame.columns
    got = {r["value"] for r in found.collect()}
    assert set(range(number)) <= got
    # the share of set bits is at most one in SPREAD
    assert len(got) - number <= 1.2 * (100_000 - number) / bitmaps.SPREAD


def test_keys_beyond_the_limit_leave_all_rows(spark):
    frame = spark.range(10).selectExpr("cast(id AS string) AS id")
    assert bitmaps.likely_rows(frame, frame, "id", limit=10).count() == 10


def test_history_is_reduced_before_it_is_shuffled(spark):
    """Ids too many for a broadcast: the rows that reach the shuffle are near the batch."""
    ids = spark.range(3000).selectExpr("concat('id', id) AS id")
    history = spark.range(60_000).selectExpr("concat('id', id % 30000) AS id", "id AS day")
    limit = 60_000  # bytes: the ids take more, their bitmap less
    found = merge.rows_of_batch(history, ids, limit)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bitmap" in plan and "hashpartitioning" not in plan
    rows = found.count()
    assert 6000 <= rows < 6000 + 54_000 / 6
    assert found.join(ids, "id", "left_semi").count() == 6000

import random

import pytest
from pyspark.sql import functions as F

from reviewloom import schemas
from reviewloom.operators import joins, merge

FIELDS = schemas.REVIEW_FIELDS
BASE = {
    "name_client": "ANA",
    "app": "bank_pf",
    "im_version": "1.0",
    "im_rating": "5",
    "title": "T",
    "content": "C",
    "updated": "u1",
    "segmento": "pf",
}


def row(id_, **values):
    full = {"id": id_, **BASE, **values}
    return tuple(full[name] for name in FIELDS)


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), ", ".join(f"{n} string" for n in FIELDS))


def past(spark, *dated):
    return spark.createDataFrame([r + (d,) for d, r in dated], schemas.HISTORY)


def histories(frame):
    return {
        r["id"]: None
        if r["historical_data"] is None
        else [tuple(e) for e in r["historical_data"]]
        for r in frame.select("id", "historical_data").collect()
    }


def entry(**values):
    full = {**BASE, **values}
    return tuple(full[name] for name in schemas.PAYLOAD)


@pytest.fixture(params=["broadcast", "broadcast ids", "salted"])
def limit(request):
    """Sizes that lead to each way of joining, for batches of short ids."""
    return {"broadcast": 50_000_000, "broadcast ids": 100, "salted": -1}[request.param]


def test_changes_of_each_tracked_field(spark, limit):
    old = past(
        spark,
        ("20240101", row("same")),
        ("20240101", row("title", title="OLD")),
        ("20240101", row("content", content="OLD")),
        ("20240101", row("version", im_version="0.9")),
        ("20240101", row("rating", im_rating="1")),
        ("20240101", row("both", title="OLD", content="OLD")),
        ("20240101", row("untracked", app="other", segmento="pj", name_client="X")),
        ("20240101", row("from_null", title=None)),
        ("20240101", row("gone")),
    )
    names = ("same title content version rating both untracked from_null".split())
    new = batch(spark, *(row(n) for n in names), row("to_null", title=None), row("fresh"))
    old = old.unionByName(past(spark, ("20240101", row("to_null"))))
    found = histories(merge.merge_snapshots(new, old, broadcast_limit=limit))
    assert found == {
        "same": [],
        "title": [entry(title="OLD")],
        "content": [entry(content="OLD")],
        "version": [entry(im_version="0.9")],
        "rating": [entry(im_rating="1")],
        "both": [entry(title="OLD", content="OLD")],
        "untracked": [],
        "from_null": [],
        "to_null": [],
        "gone": [],
        "fresh": [],
    }


def test_history_is_distinct_and_in_order(spark, limit):
    old = past(
        spark,
        ("20240103", row("1", title="B")),
        ("20240101", row("1", title="B")),
        ("20240102", row("1", title="A")),
        ("20240104", row("1", title="T")),
    )
    merged = merge.merge_snapshots(batch(spark, row("1")), old, broadcast_limit=limit)
    assert histories(merged) == {"1": [entry(title="B"), entry(title="A")]}


def test_new_values_win_and_gaps_are_filled_from_the_newest_old_row(spark, limit):
    old = past(
        spark,
        ("20240102", row("1", title="NEWEST", updated="u2")),
        ("20240101", row("1", title="OLDEST", updated="u1")),
        ("20240102", row("2", name_client="BEA", segmento="pj", updated="u9")),
    )
    new = batch(spark, row("1", title=None, updated="u3", im_rating="2"))
    current = merge.merge_snapshots(new, old, broadcast_limit=limit)
    found = {r["id"]: r for r in current.collect()}
    assert (found["1"]["title"], found["1"]["updated"], found["1"]["im_rating"]) == (
        "NEWEST",
        "u3",
        "2",
    )
    carried = found["2"]
    assert (carried["name_client"], carried["segmento"], carried["updated"]) == ("BEA", "pj", "u9")


def test_empty_sides(spark, limit):
    nothing_old = past(spark, ("20240101", row("1"))).limit(0)
    nothing_new = batch(spark, row("1")).limit(0)
    only_new = merge.merge_snapshots(batch(spark, row("1")), nothing_old, broadcast_limit=limit)
    assert histories(only_new) == {"1": []}
    only_old = merge.merge_snapshots(
        nothing_new, past(spark, ("20240101", row("2"))), broadcast_limit=limit
    )
    assert histories(only_old) == {"2": []}


def test_merging_a_snapshot_with_itself_changes_nothing(spark, limit):
    rows = [row(str(i), title=f"T{i}") for i in range(20)]
    merged = merge.merge_snapshots(
        batch(spark, *rows), past(spark, *(("20240101", r) for r in rows)), broadcast_limit=limit
    )
    assert all(h == [] for h in histories(merged).values())
    assert sorted(tuple(r)[:-1] for r in merged.select(*FIELDS, "historical_data").collect()) == sorted(rows)


def test_pruned_newest_rows_are_the_same(spark, rows_of):
    old = past(
        spark,
        ("20240101", row("1")),
        ("20240103", row("1", title="X")),
        ("20240102", row("2")),
    )
    new = batch(spark, row("1"))
    plain = merge.merge_snapshots(new, old)
    pruned = merge.merge_snapshots(new, old, prune=True)
    assert rows_of(pruned) == rows_of(plain)


def test_only_needed_folders_are_read_for_newest_rows(spark, tmp_path):
    old = past(spark, *((f"2024010{d}", row(str(i))) for d in range(1, 6) for i in range(3)))
    path = f"{tmp_path}/silver"
    old.write.partitionBy("odate").parquet(path)
    stored = spark.read.schema(schemas.HISTORY).parquet(path)
    newest = merge.latest_rows(merge.since_all_newest(stored, merge.tally_history(stored)))
    assert newest.count() == 3
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(odate" in plan and "Subquery" in plan


def test_label_names_the_first_difference(spark, rows_of):
    frame = spark.createDataFrame(
        [
            ("a", "b", "c", "d", "1", "2", "1", "2"),
            ("a", "a", "c", "d", "1", "2", "1", "2"),
            ("a", "a", "c", "c", "1", "2", "1", "2"),
            ("a", "a", "c", "c", "1", "1", "1", "2"),
            ("a", None, "c", None, None, "2", "1", "1"),
        ],
        "new_title string, old_title string, new_content string, old_content string, "
        "new_im_version string, old_im_version string, new_im_rating string, old_im_rating string",
    )
    found = frame.select(merge.change_label().alias("l"), merge.change_flag().alias("f")).collect()
    assert [(r["l"], r["f"]) for r in found] == [
        ("title", True),
        ("content", True),
        ("im_version", True),
        ("im_rating", True),
        (None, False),
    ]


@pytest.fixture
def skewed(spark):
    """A key with a third of 3,000 rows, and keys of one side only."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    left = spark.range(3000).select(key.alias("k"), F.col("id").alias("v"))
    right = left.select("k").distinct().filter("k not in ('k1', 'k2')").withColumn("w", F.hash("k"))
    return left, right.unionByName(spark.createDataFrame([("other", 1)], "k string, w int"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, rows_of, how):
    left, right = skewed
    assert rows_of(joins.salted_join(left, right, "k", how)) == rows_of(left.join(right, "k", how))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(skewed, rows_of, how):
    left, right = skewed
    found = joins.salted_join(left, right, "k", how, task_bytes=200)
    assert rows_of(found) == rows_of(left.join(right, "k", how))


def test_hot_keys_follow_bytes_per_task(spark):
    """A key of 0.3 % of the rows is hot where it takes more than a task should hold."""
    key = F.when(F.col("id") < 30, F.lit("warm")).otherwise(F.concat(F.lit("k"), "id"))
    frame = spark.range(10_000).select(key.alias("k"), F.lit("x" * 96).alias("v"))
    assert [tuple(r) for r in joins.hot_keys(frame, "k", 1000).collect()] == [("warm", 3)]
    assert joins.hot_keys(frame, "k", 3000).count() == 0


def test_salted_join_refuses_full_outer(skewed):
    with pytest.raises(ValueError):
        joins.salted_join(*skewed, "k", "full_outer")


@pytest.mark.parametrize("options", [{}, {"small": True}, {"salted": True}])
def test_outer_in_parts_equals_full_outer(skewed, rows_of, options):
    left, right = skewed
    found = joins.outer_in_parts(left, right, "k", **options)
    assert rows_of(found, "k", "v", "w") == rows_of(left.join(right, "k", "full_outer"), "k", "v", "w")


def test_rows_with_keys_keeps_copies_of_hot_keys(spark, rows_of):
    frame = spark.createDataFrame(
        [("hot", "x")] * 40 + [("rare", "y")] * 2 + [(f"s{i}", "z") for i in range(50)],
        "k string, v string",
    )
    repeated = joins.key_tally(frame, "k").filter("n > 1")
    for options in ({}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "task_bytes": 50}):
        found = joins.rows_with_keys(frame, repeated, "k", **options)
        assert rows_of(found) == [("hot", "x")] * 40 + [("rare", "y")] * 2
        rest = joins.rows_with_keys(frame, repeated, "k", "left_anti", **options)
        assert rest.count() == 50


def brute_force(new_rows, dated_rows):
    """The merge spelt out row by row."""
    position = {name: i for i, name in enumerate(FIELDS)}
    new = {r[0]: r for r in new_rows}
    old = {}
    for day, r in dated_rows:
        old.setdefault(r[0], []).append((day, r))
    result = {}
    for key in new.keys() | old.keys():
        versions = sorted(old.get(key, []), key=lambda v: v[0])
        newest = versions[-1][1] if versions else (None,) * len(FIELDS)
        fresh = new.get(key, (None,) * len(FIELDS))
        values = tuple(f if f is not None else o for f, o in zip(fresh, newest))
        history = []
        for _, r in versions:
            changed = any(
                fresh[position[t]] is not None
                and r[position[t]] is not None
                and fresh[position[t]] != r[position[t]]
                for t in schemas.TRACKED
            )
            payload = tuple(r[position[name]] for name in schemas.PAYLOAD)
            if changed and payload not in history:
                history.append(payload)
        result[key] = ((key, *values[1:]), history)
    return result


def test_random_merge_equals_brute_force(spark, limit):
    dice = random.Random(7)

    def some(id_):
        return row(
            id_,
            title=dice.choice(["A", "B", None]),
            content=dice.choice(["x", "y", None]),
            im_version=dice.choice(["1", "2", None]),
            im_rating=dice.choice(["1", "5", None]),
            segmento=dice.choice(["pf", "pj"]),
            updated=dice.choice(["u1", None]),
        )

    new = [some(f"id{i}") for i in range(0, 30)]
    dated = [
        (f"202401{day:02}", some(f"id{i}"))
        for i in range(10, 45)
        for day in range(1, 15)
        if dice.random() < 0.6
    ]
    merged = merge.merge_snapshots(batch(spark, *new), past(spark, *dated), broadcast_limit=limit)
    found = {
        r["id"]: (tuple(r[n] for n in FIELDS), [tuple(e) for e in r["historical_data"]])
        for r in merged.collect()
    }
    assert found == brute_force(new, dated)

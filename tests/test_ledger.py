"""The ledger of versions against full rebuilds, and tables clustered by id."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom import schemas
from reviewloom.operators import ledger, merge
from reviewloom.sinks import buckets

FIELDS = ", ".join(f"{name} string" for name in schemas.REVIEW_FIELDS)
DATED = FIELDS + ", odate string"


def review(id_, **values):
    base = {name: "x" for name in schemas.REVIEW_FIELDS}
    return tuple({**base, "id": id_, **values}.values())


def random_row(rng, id_):
    pick = lambda values: rng.choice(values)
    return review(
        id_,
        title=pick(["a", "b", None]),
        content=pick(["c", "d"]),
        im_version=pick(["1", "2", None]),
        im_rating=pick(["4", "5"]),
        name_client=pick(["n", "m"]),
    )


def entries(frame):
    return sorted((tuple(r[n] for n in ("id", *schemas.PAYLOAD, "odate")) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_thirty_days_equal_a_full_rebuild(spark, tmp_path, seed):
    """Day by day: snapshots carry old ids forward, the ledger gets what is new only."""
    rng = random.Random(seed)
    snapshot, history, path = {}, [], str(tmp_path / "ledger")
    layout = "id string, " + ", ".join(f"{n} string" for n in schemas.PAYLOAD) + ", odate string"
    kept = spark.createDataFrame([], layout)
    rows = []
    for day in range(1, 31):
        odate = f"202401{day:02d}"
        batch = {i: random_row(rng, i) for i in rng.sample([f"id{k}" for k in range(40)], 6)}
        snapshot = {**snapshot, **batch}
        new = spark.createDataFrame(list(batch.values()), FIELDS)
        known = ledger.known_versions(kept, new.select("id"))
        found = ledger.new_versions(new, known).collect()
        rows += [(*r, odate) for r in found]
        kept = spark.createDataFrame(rows, layout)
        history += [(*row, odate) for row in snapshot.values()]
    whole = ledger.versions_of(spark.createDataFrame(history, DATED))
    assert entries(kept) == entries(whole)
    # the day after: the same result from the ledger and from all snapshots
    new = spark.createDataFrame([random_row(rng, f"id{k}") for k in range(0, 50, 2)], FIELDS)
    newest = spark.createDataFrame(list(snapshot.values()), FIELDS)
    known = ledger.known_versions(kept, new.select("id"))
    by_ledger = ledger.merge_with_ledger(new, newest, known)
    by_history = merge.merge_snapshots(new, spark.createDataFrame(history, DATED))
    assert sorted(map(repr, by_ledger.collect())) == sorted(map(repr, by_history.select(*by_ledger.columns).collect()))


@pytest.mark.parametrize("limit", [0, 10**9])
def test_many_or_few_ids_and_changes(spark, limit):
    rows = [("1", "t", None, "a", "s", "v", "4", "20240101"), ("2", "t", "c", "a", "s", "v", "4", "20240102")]
    names = ["id", "title", "content", "app", "segmento", "im_version", "im_rating", "odate"]
    kept = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    ids = spark.createDataFrame([("1",), ("3",)], "id string")
    assert [r["id"] for r in ledger.known_versions(kept, ids, limit).collect()] == ["1"]
    new = spark.createDataFrame([review("1", title="u"), review("2", title="t", content="c", im_version="v", im_rating="4")], FIELDS)
    found = ledger.replaced_versions(new, kept, small=limit > 0).collect()
    assert [(r["id"], r["first_seen"], r["title"], r["content"]) for r in found] == [("1", 20240101, "t", None)]


def test_changed_ids(spark):
    before = spark.createDataFrame([review("1"), review("2"), review("3", title=None)], FIELDS)
    after = spark.createDataFrame([review("1"), review("2", title=None), review("3", title=""), review("4")], FIELDS)
    assert sorted(r["id"] for r in ledger.changed_ids(before, after).collect()) == ["2", "3", "4"]
    assert ledger.changed_ids(before, before).count() == 0
    assert ledger.changed_ids(before.limit(0), before).count() == 3


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.range(500).select(
        F.col("id").cast("string"), *(F.lit("x").alias(n) for n in schemas.REVIEW_FIELDS[1:])
    )
    for day in ("20240101", "20240102"):
        buckets.write_load_date(rows.withColumn("title", F.lit(day)), path, day, 4)
    layout = rows.schema
    return path, layout


def test_load_dates_in_buckets(spark, stored):
    path, layout = stored
    again = spark.createDataFrame([review("new")], FIELDS)
    assert buckets.write_load_date(again, path, "20240102", 4)
    read = lambda: {r["odate"]: r["count"] for r in buckets.read(spark, path, layout, 4).groupBy("odate").count().collect()}
    assert read() == {"20240101": 500, "20240102": 1}
    assert not buckets.write_load_date(again.limit(0), path, "20240102", 4)
    assert read() == {"20240101": 500}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def below_exchanges(plan):
    """The lines of a plan that lie below an exchange."""
    found, above = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if above is not None and depth <= above:
            above = None
        if above is not None:
            found.append(line)
        elif "Exchange hashpartitioning" in line:
            above = depth
    return found


def test_bucketed_sides_are_not_shuffled(spark, stored):
    path, layout = stored
    table = buckets.read(spark, path, layout, 4)
    newest = table.filter("odate = '20240102'").drop("odate")
    new = spark.createDataFrame([review(str(k), title="u") for k in range(0, 900, 3)], FIELDS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge.current_snapshot(new, newest)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        known = ledger.known_versions(table.select("id", *schemas.PAYLOAD, "odate"), new.select("id"), 0)
        known_plan = known._jdf.queryExecution().executedPlan().toString()
        assert merged.count() == 500 + 133
        assert known.count() == 2 * 167
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (plan, known_plan):
        assert "Bucketed: true" in text
        assert text.count("Exchange hashpartitioning") == 1
        assert not any("Bucketed: true" in line for line in below_exchanges(text))


def exchanges(frame):
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_new_versions_leaves_rows_in_place(spark):
    """Only digests are shuffled; equal rows still give one version, also where texts could be
    taken for each other or are null."""
    layout = ", ".join(f"{n} string" for n in ("id", *schemas.PAYLOAD))
    row = lambda id_, title, content: (id_, title, content, "a", "s", None, "4")
    known = [row("1", "t", "c"), row("2", "", None), row("3", "ab", "c"), row(None, "t", "c")]
    rows = [*known, row("2", None, ""), row("3", "a", "bc"), row("4", "t", "c"), row("4", "t", "c"), row("5", "t", "c")]
    old, new = spark.createDataFrame(known, layout), spark.createDataFrame(rows, layout)
    found = ledger.new_versions(new, old)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([*rows[4:7], rows[8]], key=repr)
    once = ledger.new_versions(new.filter("id <> '4'"), old)
    assert exchanges(once) == 0 and once.count() == 3


def test_a_merge_shuffles_each_side_once(spark):
    rows = [review(str(k), title="t") for k in range(40)]
    newest = spark.createDataFrame(rows, FIELDS)
    kept = newest.select("id", *schemas.PAYLOAD).withColumn("odate", F.lit("20240101"))
    kept = kept.unionByName(kept.withColumn("title", F.lit("s")).withColumn("odate", F.lit("20240102")))
    new = spark.createDataFrame([review(str(k), title="u" if k % 2 else None) for k in range(30, 50)], FIELDS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = ledger.merge_with_ledger(new, newest, kept, 0, mark="is_new")
        assert exchanges(merged) == 3
        first = ledger.merge_with_ledger(new, newest.limit(0), kept.limit(0), 0)
        assert exchanges(first) <= 2
        found = {r["id"]: r for r in merged.collect()}
        assert first.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == 50 and sorted(found, key=int)[30:] == [i for i in sorted(found, key=int) if found[i]["is_new"]]
    assert [e["title"] for e in found["31"]["historical_data"]] == ["t", "s"]
    assert (found["30"]["title"], found["30"]["historical_data"], found["1"]["historical_data"]) == ("t", [], [])
    small = ledger.merge_with_ledger(new, newest, kept, 10**9, mark="is_new")
    assert sorted(map(repr, small.collect())) == sorted(map(repr, found.values()))

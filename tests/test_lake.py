"""Load dates run in any order, runs that fail midway, and what a run reads."""

import random

import pytest

from reviewloom import schemas, session
from reviewloom.operators import ledger
from reviewloom.plans import daily_run, lake
from reviewloom.plans.config import RunConfig
from reviewloom.sinks import marks, partitions
from reviewloom.sources import history

COLUMNS = schemas.BRONZE.fieldNames()


def review(id_, **values):
    base = dict.fromkeys(COLUMNS) | {"author_name": "jo", "content": "c", "im_rating": 4, "title": "t"}
    return tuple({**base, "id": id_, **values}.values())


class Lake:
    def __init__(self, spark, base, **options):
        self.spark, self.base, self.options = spark, str(base), options

    def config(self, day):
        places = {n: f"{self.base}/{n}" for n in ("bronze", "silver", "quarantine", "metrics")}
        return RunConfig(env="pro", as_of=day, **places, **self.options)

    def load(self, day, reviews):
        folder = f"{self.base}/bronze/appleStore/bank_pf/odate={day}"
        self.spark.createDataFrame(reviews, schemas.BRONZE).coalesce(1).write.mode("overwrite").parquet(folder)

    def run(self, day):
        return daily_run.run(self.spark, self.config(day))

    def state(self, day):
        """Silver, quarantine and ledger as of the end of ``day``."""
        config = self.config(day)
        valid = lake.day_of(self.spark, config.silver_path, schemas.SILVER, day).collect()
        invalid = lake.day_of(self.spark, config.quarantine_path, schemas.QUARANTINE, day).collect()
        known = lake.days(self.spark, config)
        entries = lake.ledger(self.spark, config, known, f"{day}~").select("id", *schemas.PAYLOAD, "odate").collect()
        return [sorted(map(repr, rows)) for rows in (valid, invalid, entries)]


def random_batch(rng):
    rows = []
    for k in rng.sample(range(8), rng.randint(1, 6)):
        copies = 2 if rng.random() < 0.1 else 1
        for _ in range(copies):
            rows.append(
                review(
                    str(k),
                    title=rng.choice(["t", "u", None]),
                    content=rng.choice(["c", "d", None]),
                    author_name=rng.choice(["jo", "jo", None]),
                )
            )
    return rows + ([review(None)] if rng.random() < 0.3 else [])


@pytest.mark.parametrize("seed, in_buckets", [(1, None), (2, 2)])
def test_any_order_of_days_gives_the_same_end(spark, tmp_path, seed, in_buckets):
    rng = random.Random(seed)
    days = ["20240101", "20240102", "20240103"]
    batches = {day: random_batch(rng) for day in days}
    ordered = Lake(spark, tmp_path / "ordered", buckets=in_buckets)
    shuffled = Lake(spark, tmp_path / "shuffled", buckets=in_buckets)
    for day in days:
        ordered.load(day, batches[day])
        ordered.run(day)
    # a wrong first version of one day, then all days late and out of order
    order = [days[2], days[0], days[1]] if seed == 1 else [days[1], days[2], days[0]]
    shuffled.load(order[0], random_batch(rng))
    shuffled.run(order[0])
    for day in order[1:]:
        shuffled.load(day, batches[day])
        shuffled.run(day)
    shuffled.load(order[0], batches[order[0]])
    shuffled.run(order[0])
    for day in days:
        assert shuffled.state(day) == ordered.state(day), day
    whole = history.read_history(spark, ordered.config(days[0]).silver_path, "20240104")
    rebuilt = ledger.versions_of(whole).select("id", *schemas.PAYLOAD, "odate").collect()
    assert ordered.state(days[2])[2] == sorted(map(repr, rebuilt))


def test_a_run_that_fails_between_its_writes_is_left_out(spark, tmp_path, monkeypatch):
    work = Lake(spark, tmp_path)
    work.load("20240101", [review("1")])
    work.run("20240101")
    work.load("20240102", [review("1", title="u"), review("2"), review("3", content=None)])
    write = partitions.write_load_date

    def failing(frame, path, *args, **options):
        if path == work.config("20240102").silver_path:
            raise OSError("disk full")
        return write(frame, path, *args, **options)

    monkeypatch.setattr(partitions, "write_load_date", failing)
    with pytest.raises(OSError):
        work.run("20240102")
    monkeypatch.setattr(partitions, "write_load_date", write)
    config = work.config("20240103")
    known = lake.days(spark, config)
    assert known.pending == ["20240102"] and list(known.complete) == ["20240101"]
    # its quarantine and ledger are there, but the next day goes on from the day before
    assert lake.ledger(spark, config, known, "20240103").count() == 1
    work.load("20240103", [review("1", title="v")])
    work.run("20240103")
    rows = {r["id"]: r for r in lake.day_of(spark, config.silver_path, schemas.SILVER, "20240103").collect()}
    assert list(rows) == ["1"] and [e["title"] for e in rows["1"]["historical_data"]] == ["T"]
    # run again, it is taken into the later day
    work.run("20240102")
    rows = {r["id"]: r for r in lake.day_of(spark, config.silver_path, schemas.SILVER, "20240103").collect()}
    assert sorted(rows) == ["1", "2"]
    assert [e["title"] for e in rows["1"]["historical_data"]] == ["T", "U"]
    assert lake.days(spark, config).pending == []


def test_silver_without_marks_is_taken_over(spark, tmp_path):
    work = Lake(spark, tmp_path)
    config = work.config("20240103")
    rows = [(*["1", "JO", "bank_pf", None, "4", title, "C", None, "pf"], None, day) for title, day in (("A", "20240101"), ("B", "20240102"))]
    layout = ", ".join(f"{n} string" for n in schemas.REVIEW_FIELDS) + ", historical_data array<string>, odate string"
    partitions.write_partitioned(spark.createDataFrame(rows, layout).drop("historical_data"), config.silver_path)
    work.load("20240103", [review("1", title="c")])
    work.run("20240103")
    (row,) = lake.day_of(spark, config.silver_path, schemas.SILVER, "20240103").collect()
    assert [e["title"] for e in row["historical_data"]] == ["A", "B"]


def test_a_run_reads_the_newest_folder_and_the_ledger_only(spark, tmp_path):
    """And leaves no scratch tables behind."""
    work = Lake(spark, tmp_path)
    for day in ("20240101", "20240102", "20240103"):
        work.load(day, [review("1", title=day), review("2")])
        work.run(day)
    config = work.config("20240104")
    known = lake.days(spark, config)
    newest = lake.snapshot(spark, config, known, known.before("20240104"))
    assert {f.split("odate=")[1][:8] for f in newest.inputFiles()} == {"20240103"}
    # the second review has not changed since the first day
    by_day = lake.ledger(spark, config, known, "20240104").groupBy("odate").count()
    assert sorted(tuple(r) for r in by_day.collect()) == [("20240101", 2), ("20240102", 1), ("20240103", 1)]
    scratch = spark.conf.get("spark.checkpoint.dir")
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    before = {str(s.getPath()) for s in system.listStatus(path)} if system.exists(path) else set()
    work.load("20240104", [review("1", title="new")])
    work.run("20240104")
    assert {str(s.getPath()) for s in system.listStatus(path)} == before


def test_marks(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert marks.read(spark, path) is None
    marks.add(spark, path, ["20240101", "20240102"], "a", marks.COMPLETE)
    marks.add(spark, path, ["20240102"], "b", marks.BEGUN, 4)
    marks.add(spark, path, ["20240103"], "c", marks.BEGUN, 4)
    marks.add(spark, path, ["20240103"], "c", marks.COMPLETE, 4)
    found = marks.read(spark, path)
    assert found == marks.Days({"20240101": None, "20240103": 4}, ["20240102"])
    assert found.before("20240103") == "20240101" and found.before("20240101") is None
    assert found.after("20240101") == ["20240103"]


@pytest.mark.parametrize("in_buckets", [None, 2])
def test_whole_rows_are_stored_aside_no_oftener_than_needed(spark, tmp_path, monkeypatch, in_buckets):
    """A load date that is brought up to date is written straight over its old files, and the
    first one has its merged rows stored only."""
    stored, store = [], session.store

    def watched(frame, *args, **options):
        found = store(frame, *args, **options)
        if "content" in frame.columns and not found.isEmpty():
            stored.append(frame.columns)
        return found

    monkeypatch.setattr(session, "store", watched)
    work = Lake(spark, tmp_path, buckets=in_buckets)
    work.load("20240102", [review("1", title="u"), review("2", content=None), review(None)])
    work.run("20240102")
    assert len(stored) == 1
    work.load("20240101", [review("1"), review("3")])
    work.run("20240101")
    # the first day's merged rows; the second day's batch, ledger entries and merged rows
    assert len(stored) == 1 + 1 + 3
    valid, invalid, entries = work.state("20240102")
    assert [len(valid), len(invalid), len(entries)] == [2, 2, 3]

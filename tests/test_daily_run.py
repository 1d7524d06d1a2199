import json

import pytest

from reviewloom import schemas
from reviewloom.plans import daily_run
from reviewloom.plans.config import Labels, RunConfig
from reviewloom.plans.stage_metrics import StageMetrics
from reviewloom.sinks import metrics

COLUMNS = schemas.BRONZE.fieldNames()


def review(id_, **values):
    base = dict.fromkeys(COLUMNS) | {
        "author_name": "josé",
        "content": "está na hora",
        "im_rating": 4,
        "im_version": "24.7.7",
        "title": "Face ID",
        "updated": "2024-08-30T08:10:10-07:00",
    }
    return tuple({**base, "id": id_, **values}.values())


@pytest.fixture
def lake(spark, tmp_path):
    class Lake:
        def config(self, day, **options):
            return RunConfig(
                env="pre",
                as_of=day,
                bronze=f"{tmp_path}/bronze",
                silver=f"{tmp_path}/silver",
                quarantine=f"{tmp_path}/quarantine",
                metrics=f"{tmp_path}/metrics",
                **options,
            )

        def load(self, day, folder, *reviews):
            spark.createDataFrame(list(reviews), schemas.BRONZE).write.mode("overwrite").parquet(
                f"{tmp_path}/bronze/appleStore/{folder}/odate={day}"
            )

        def run(self, day, **options):
            return daily_run.run(spark, self.config(day, **options))

        def silver(self, day):
            frame = spark.read.parquet(f"{tmp_path}/silver/appleStore/odate={day}")
            return {r["id"]: r for r in frame.collect()}

        def quarantined(self, day):
            frame = spark.read.parquet(f"{tmp_path}/quarantine/appleStore/odate={day}")
            return sorted(((r["id"], r["reasons"]) for r in frame.collect()), key=repr)

        def documents(self, index):
            found = metrics.read_documents(spark, f"{tmp_path}/metrics", index)
            return [json.loads(r["document"]) for r in found.collect()]

    return Lake()


def test_three_days(lake):
    lake.load("20240101", "bank_pf", review("1"), review("2"), review(None), review("3", content=None))
    lake.load("20240101", "bank_pj", review("7"), review("7", title="again"))
    lake.run("20240101")
    day1 = lake.silver("20240101")
    assert sorted(day1) == ["1", "2"]
    assert (day1["1"]["name_client"], day1["1"]["content"]) == ("JOSE", "ESTA NA HORA")
    assert (day1["1"]["app"], day1["1"]["segmento"], day1["1"]["im_rating"]) == ("bank_pf", "pf", "4")
    assert day1["1"]["historical_data"] == []
    assert lake.quarantined("20240101") == [
        ("3", ["null content"]),
        ("7", ["duplicate key"]),
        ("7", ["duplicate key"]),
        (None, ["null id"]),
    ]

    lake.load("20240102", "bank_pf", review("1", title="new", im_rating=1), review("8"))
    lake.run("20240102")
    lake.load("20240103", "bank_pf", review("1", title="newer"))
    lake.run("20240103")
    day3 = lake.silver("20240103")
    assert sorted(day3) == ["1", "2", "8"]
    assert [(e["title"], e["im_rating"]) for e in day3["1"]["historical_data"]] == [
        ("FACE ID", "4"),
        ("NEW", "1"),
    ]
    assert day3["2"]["historical_data"] == []
    assert day3["2"]["updated"] == "2024-08-30T08:10:10-07:00"

    first, second, third = sorted(lake.documents("datametrics"), key=lambda d: d["timestamp"])
    assert first["valid_data"] == {"count": 2, "percentage": pytest.approx(100 / 3)}
    assert first["invalid_data"]["count"] == 4
    assert first["total_records"] == 6
    assert first["validation_results"]["duplicate_check"]["code"] == 409
    assert "'id': 1, 'content': 1" in first["validation_results"]["null_check"]["message"]
    assert (first["success_count"], first["error_count"]) == (1, 2)
    assert first["type_client"] == "PF"
    assert int(first["stages"]["numTasks"]) > 0
    assert third["valid_data"]["count"] == 3 and third["error_count"] == 0


def test_rerun_of_a_day_replaces_it(lake):
    lake.load("20240101", "bank_pf", review("1"))
    lake.run("20240101")
    lake.load("20240102", "bank_pf", review("1", title="wrong"), review(None))
    lake.run("20240102")
    lake.load("20240102", "bank_pf", review("1", title="right"))
    lake.run("20240102")
    assert lake.silver("20240102")["1"]["title"] == "RIGHT"
    assert len(lake.silver("20240102")["1"]["historical_data"]) == 1
    assert lake.quarantined("20240102") == []


def test_day_without_data_carries_everything_forward(lake):
    lake.load("20240101", "bank_pj", review("1"))
    lake.run("20240101")
    lake.run("20240102")
    assert sorted(lake.silver("20240102")) == ["1"]


def test_first_day_without_data(lake, tmp_path):
    lake.run("20240101")
    assert not (tmp_path / "silver").exists()
    (document,) = lake.documents("datametrics")
    assert document["total_records"] == 0
    assert document["valid_data"]["percentage"] == 0.0
    assert document["type_client"] == "NA"


def test_a_configured_segment_is_stored(lake):
    lake.load("20240101", "bank_mei", review("1"))
    lake.run("20240101", segments=("pf", "mei"))
    assert lake.silver("20240101")["1"]["segmento"] == "mei"


def test_long_histories_stay_nested(lake):
    for day in range(1, 5):
        lake.load(f"2024010{day}", "bank_pf", review("1", title=f"t{day}"))
        lake.run(f"2024010{day}")
    assert len(lake.silver("20240104")["1"]["historical_data"]) == 3


def test_failure_is_recorded_and_raised(lake, spark, tmp_path):
    lake.load("20240101", "bank_pf", review("1"))
    labels = Labels(tower="tower-1")
    blocked = lake.config("20240101", labels=labels)
    (tmp_path / "silver").write_text("a file where the folder should be")
    with pytest.raises(Exception) as raised:
        daily_run.run(spark, blocked)
    (document,) = lake.documents("datametrics_fail")
    assert document["client"] == ["pf"]
    assert document["tower"] == "tower-1"
    assert document["error"] and document["error"][:40] == str(raised.value)[:40]


def test_failed_sink_does_not_hide_the_error(lake, spark, tmp_path):
    (tmp_path / "silver").write_text("x")
    (tmp_path / "metrics").write_text("x")
    lake.load("20240101", "bank_pf", review("1"))
    with pytest.raises(Exception) as raised:
        lake.run("20240101")
    assert "silver" in str(raised.value)


def test_load_date_format():
    with pytest.raises(ValueError):
        RunConfig("pre", "2024-01-01", "b", "s", "q", "m")


def test_stage_metrics_need_begin_and_end(spark):
    stages = StageMetrics(spark)
    with pytest.raises(ValueError):
        stages.end()
    stages.begin()
    with pytest.raises(ValueError):
        stages.report()
    spark.range(1000).selectExpr("hash(id) AS h").groupBy("h").count().count()
    stages.end()
    report = stages.report()
    assert int(report["numStages"]) >= 2
    assert int(report["shuffleRecordsWritten"]) >= 1000

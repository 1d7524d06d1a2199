import json

import pytest

from reviewloom.sinks import metrics, partitions


def day(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def stored(spark, path, rows_of):
    return rows_of(spark.read.schema("id string, odate string").parquet(path))


def test_only_the_load_date_is_replaced(spark, tmp_path, rows_of):
    path = f"{tmp_path}/t"
    assert partitions.write_load_date(day(spark, "1"), path, "20240101")
    assert partitions.write_load_date(day(spark, "2"), path, "20240102")
    assert partitions.write_load_date(day(spark, "3", "4"), path, "20240102")
    assert stored(spark, path, rows_of) == [("1", "20240101"), ("3", "20240102"), ("4", "20240102")]
    assert list((tmp_path / "t" / "odate=20240101").glob("*.snappy.parquet"))


def test_no_rows_write_nothing(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert not partitions.write_load_date(day(spark, "1").limit(0), path, "20240101")
    assert not (tmp_path / "t").exists()


def test_empty_rerun_clears_its_day(spark, tmp_path, rows_of):
    path = f"{tmp_path}/t"
    partitions.write_load_date(day(spark, "1"), path, "20240101")
    partitions.write_load_date(day(spark, "2"), path, "20240102")
    assert not partitions.write_load_date(day(spark, "1").limit(0), path, "20240102")
    assert stored(spark, path, rows_of) == [("1", "20240101")]


def test_table_can_be_read_while_its_day_is_replaced(spark, tmp_path, rows_of):
    path = f"{tmp_path}/t"
    partitions.write_load_date(day(spark, "1"), path, "20240101")
    earlier = spark.read.parquet(path).select("id")
    partitions.write_load_date(earlier, path, "20240102")
    assert stored(spark, path, rows_of) == [("1", "20240101"), ("1", "20240102")]


def test_arguments(spark):
    with pytest.raises(TypeError):
        partitions.write_load_date([1], "/tmp/x", "20240101")
    with pytest.raises(ValueError):
        partitions.write_load_date(day(spark, "1"), "", "20240101")


def doc(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "document string")


def test_documents_are_appended_by_index(spark, tmp_path, rows_of):
    path = f"{tmp_path}/m"
    metrics.save_run("success", path, "a", doc(spark, '{"n": 1}'))
    metrics.save_run("SUCCESS", path, "a", doc(spark, '{"n":\n 2}'))
    metrics.save_run("fail", path, "b", doc(spark, '{"n": 3}'), ValueError("x"))
    found = metrics.read_documents(spark, path)
    assert sorted((r["index"], json.loads(r["document"])["n"]) for r in found.collect()) == [
        ("a", 1),
        ("a", 2),
        ("b", 3),
    ]
    assert metrics.read_documents(spark, path, "b").count() == 1
    parsed = metrics.parse_documents(metrics.read_documents(spark, path, "a"), "n int")
    assert rows_of(parsed) == [(1,), (2,)]


def test_malformed_documents_are_refused(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        metrics.save_run("success", f"{tmp_path}/m", "a", doc(spark, "{not json"))


@pytest.mark.parametrize("kind, given, error", [("other", True, None), ("fail", True, None), ("success", False, None)])
def test_run_arguments(spark, tmp_path, kind, given, error):
    with pytest.raises(ValueError):
        metrics.save_run(kind, f"{tmp_path}/m", "a", doc(spark, "{}") if given else None, error)

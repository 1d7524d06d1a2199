"""Files of several layouts, and digests of whole rows."""

import math

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from reviewloom import schemas
from reviewloom.functions import digests
from reviewloom.operators import merge, quality
from reviewloom.sources import bronze, history, layouts

DECLARED = StructType(
    [StructField("id", StringType()), StructField("im_rating", IntegerType()), StructField("title", StringType())]
)


def write(spark, path, rows, layout):
    spark.createDataFrame(rows, layout).coalesce(1).write.mode("append").parquet(str(path))


def read(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def test_missing_column_and_null_are_told_apart(spark, tmp_path):
    """In one folder and over folders: NA only where the file lacks the column."""
    new = "id string, title string, segmento string"
    write(spark, tmp_path / "odate=20240101", [("1", "a")], "id string, title string")
    write(spark, tmp_path / "odate=20240102", [("2", "b", None), ("3", "c", "pf")], new)
    write(spark, tmp_path / "odate=20240102", [("4", "d")], "id string, title string")
    found = history.read_history(spark, str(tmp_path), "20240103")
    assert read(found, "id", "segmento") == [("1", "NA"), ("2", None), ("3", "pf"), ("4", "NA")]
    assert read(found.filter("segmento IS NULL"), "id") == [("2",)]
    assert read(found.filter("segmento = 'NA'"), "id") == [("1",), ("4",)]
    assert read(history.read_history(spark, str(tmp_path), "20240103", pending=["20240102"]), "id") == [("1",)]


def test_files_that_agree_are_one_frame(spark, tmp_path):
    write(spark, tmp_path / "a", [("1", 4)], "id string, im_rating int")
    write(spark, tmp_path / "b", [("2", "t")], "id string, title string")
    (found,) = layouts.scan(spark, f"{tmp_path}/*", DECLARED)
    assert read(found, "id", "im_rating", "title") == [("1", 4, None), ("2", None, "t")]


def test_types_differ_between_and_within_folders(spark, tmp_path):
    write(spark, tmp_path / "a", [("1", 4, "t")], "id string, im_rating int, title string")
    write(spark, tmp_path / "b", [("2", "5", "t"), ("3", "x", "t")], "id string, im_rating string, title string")
    write(spark, tmp_path / "c", [(4, 1)], "id bigint, im_rating bigint")
    write(spark, tmp_path / "c", [("5", "2")], "id string, im_rating string")
    found = layouts.scan(spark, f"{tmp_path}/*", DECLARED)
    assert len(found) == 3
    whole = bronze.union_segments(f.select(*bronze.standardize.conformed(f, DECLARED)) for f in found)
    assert read(whole, "id", "im_rating", "title") == [
        ("1", 4, "t"),
        ("2", 5, "t"),
        ("3", None, "t"),
        ("4", 1, None),
        ("5", 2, None),
    ]
    assert layouts.scan(spark, f"{tmp_path}/none*", DECLARED) == []


def test_segments_of_mixed_layouts(spark, tmp_path):
    base = f"{tmp_path}/appleStore"
    write(spark, f"{base}/bank_pf/odate=20240101", [("1", 4)], "id string, im_rating int")
    write(spark, f"{base}/shop_pf/odate=20240101", [("2", "3")], "id string, im_rating string")
    found = bronze.read_reviews(spark, f"{base}/*_pf/odate=20240101")
    assert found.columns == schemas.BRONZE_WITH_ORIGIN.fieldNames()
    assert read(found, "id", "im_rating", "app", "segmento") == [("1", 4, "bank_pf", "pf"), ("2", 3, "shop_pf", "pf")]


NESTED = "a string, b string, n array<string>, s struct<x: double, y: string>, d double"


def rows_of_every_kind():
    return [
        (None, "x", [], (0.0, None), 0.0),
        ("x", None, [], (0.0, None), 0.0),
        ("", "x", [], (0.0, None), 0.0),
        (None, "x", [None], (0.0, None), 0.0),
        (None, "x", [None, "a"], (0.0, None), 0.0),
        (None, "x", ["a", None], (0.0, None), 0.0),
        (None, "x", ["a"], (0.0, None), 0.0),
        (None, "x", None, (0.0, None), 0.0),
        (None, "x", [], None, 0.0),
        (None, "x", [], (None, None), 0.0),
        (None, "x", [], (0.0, "null"), 0.0),
        (None, "x", [], (0.0, None), math.nan),
        (None, 'x","b', [], (0.0, None), 0.0),
    ]


def test_digests_tell_rows_apart_and_know_equal_ones(spark):
    rows = rows_of_every_kind()
    frame = spark.createDataFrame(rows, NESTED)
    found = frame.select(digests.row_digest(frame).alias("d")).distinct().count()
    assert found == len(rows)
    zeros = spark.createDataFrame([("z", "z", [], (0.0, None), 0.0), ("z", "z", [], (-0.0, None), -0.0)], NESTED)
    assert zeros.select(digests.row_digest(zeros)).distinct().count() == 1


def test_except_rows_equals_subtract(spark):
    rows = rows_of_every_kind()
    frame = spark.createDataFrame(rows + rows[::2], NESTED)
    rejected = spark.createDataFrame(rows[1::3] + [("other", None, None, None, None)], NESTED)
    want = sorted(map(repr, frame.subtract(rejected).collect()))
    assert sorted(map(repr, quality.except_rows(frame, rejected).collect())) == want
    assert sorted(map(repr, quality.except_rows(frame, frame).collect())) == []
    assert quality.except_rows(frame, rejected.limit(0)).count() == len(rows)


def test_except_rows_compares_values_of_a_common_digest(spark, monkeypatch):
    """Even if all rows had one digest the result would be right."""
    monkeypatch.setattr(digests, "row_digest", lambda frame, columns=None: F.lit(b"same"))
    rows = rows_of_every_kind()
    frame = spark.createDataFrame(rows, NESTED)
    rejected = spark.createDataFrame(rows[:4], NESTED)
    found = quality.except_rows(frame, rejected).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, frame.subtract(rejected).collect()))


def test_newest_rows_need_no_sorted_aggregate(spark):
    day = F.concat(F.lit("2024010"), F.floor(F.col("id") / 7).cast("string"))
    stored = spark.range(50).select(
        *(F.concat(F.lit(name), F.col("id") % 7).alias(name) for name in schemas.REVIEW_FIELDS),
        day.alias("odate"),
    ).withColumn("title", F.col("odate"))
    found = merge.latest_rows(stored)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert read(found, "id", "title") == [(f"id{k}", "20240107" if k == 0 else "20240106") for k in range(7)]

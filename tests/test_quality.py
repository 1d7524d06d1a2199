import pytest

from reviewloom.operators import quality, sizing
from reviewloom.operators.standardize import conform, standardize_reviews
from reviewloom import schemas

COLUMNS = "id string, name_client string, content string, im_rating string, im_version string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


@pytest.fixture
def mixed(spark):
    return frame(
        spark,
        ("1", "A", "c", "5", "1"),
        ("2", "B", "c", "x", "1"),
        ("3", None, "c", "4", "1"),
        ("4", "D", None, None, None),
        ("5", "E", "c", "1", "1"),
        ("5", "E", "c", "1", "1"),
        ("5", "F", None, "2", "1"),
        (None, "G", "c", "3", "1"),
        (None, None, "c", "3", "1"),
    )


def test_split_is_whole(mixed, rows_of):
    valid, invalid = quality.valid_rows(mixed), quality.quarantine(mixed)
    assert rows_of(valid, "id") == [("1",), ("2",)]
    assert rows_of(valid) + rows_of(invalid.drop("reasons")) and sorted(
        rows_of(valid) + rows_of(invalid.drop("reasons")), key=repr
    ) == rows_of(mixed)


def test_reasons(mixed):
    reasons = sorted((str(r["id"]), r["name_client"], r["reasons"]) for r in quality.quarantine(mixed).fillna("-").collect())
    assert reasons == [
        ("-", "-", ["null id", "null name_client"]),
        ("-", "G", ["null id"]),
        ("3", "-", ["null name_client"]),
        ("4", "D", ["null content"]),
        ("5", "E", ["duplicate key"]),
        ("5", "E", ["duplicate key"]),
        ("5", "F", ["null content", "duplicate key"]),
    ]


def test_report(mixed):
    report = {r["check"]: r for r in quality.validation_report(quality.quality_counts(mixed)).collect()}
    duplicate, nulls, types = (report[name] for name in quality.CHECKS)
    assert (duplicate["status"], duplicate["code"], duplicate["message"]) == (
        False,
        409,
        "Registros duplicados encontrados: 1 registros com base no 'id'.",
    )
    assert (nulls["status"], nulls["code"], nulls["message"]) == (
        False,
        400,
        "Valores nulos encontrados nas colunas: "
        "{'id': 2, 'content': 2, 'im_rating': 1, 'im_version': 1}.",
    )
    assert (types["status"], types["code"]) == (False, 400)
    assert {r["total_records"] for r in report.values()} == {9}


def test_report_of_good_rows(spark):
    counts = quality.quality_counts(frame(spark, ("1", "A", "c", "5", "1")))
    report = quality.validation_report(counts)
    assert report.schema.fieldNames() == schemas.REPORT.fieldNames()
    assert [r["code"] for r in report.collect()] == [200, 200, 200]
    assert tuple(quality.check_rollup(report).first()) == (3, 0)


def test_report_of_no_rows(spark):
    counts = quality.quality_counts(frame(spark, ("1", "A", "c", "5", "1")).limit(0))
    row = counts.first()
    assert (row["total_records"], row["valid"], row["invalid"]) == (0, 0, 0)
    assert all(r["status"] for r in quality.validation_report(counts).collect())


def test_counts_agree_with_the_split(mixed):
    row = quality.quality_counts(mixed).first()
    assert row["valid"] == quality.valid_rows(mixed).count()
    assert row["invalid"] == quality.quarantine(mixed).count()


def test_null_counts(mixed, rows_of):
    assert rows_of(quality.null_counts(mixed)) == [
        ("content", 2),
        ("id", 2),
        ("im_rating", 1),
        ("im_version", 1),
    ]


def test_except_rows_compares_nulls_and_drops_copies(mixed, rows_of):
    assert rows_of(quality.except_rows(mixed, mixed.filter("id is null or id = '1'")), "id") == [
        ("2",),
        ("3",),
        ("4",),
        ("5",),
        ("5",),
    ]


def test_segment_names(spark):
    rows = spark.createDataFrame([("pj",), ("pf",), (None,), ("pf",)], "segmento string")
    assert quality.segment_names(rows).first()["names"] == ["UNKNOWN", "pf", "pj"]
    assert quality.segment_names(rows.limit(0)).first()["names"] == []


def test_sample_is_ordered(mixed):
    assert [r["id"] for r in quality.sample(mixed.filter("id is not null"), 2).collect()] == ["1", "2"]


def test_standard_columns(spark):
    values = dict.fromkeys(schemas.BRONZE_WITH_ORIGIN.fieldNames())
    values |= {"id": "1", "author_name": "josé", "title": "não", "im_rating": 4, "app": "a_pf"}
    raw = spark.createDataFrame([tuple(values.values())], schemas.BRONZE_WITH_ORIGIN)
    found = standardize_reviews(raw)
    assert len(found.columns) == 14
    row = found.first()
    assert (row["name_client"], row["title"], row["content"], row["im_rating"]) == (
        "JOSE",
        "NAO",
        None,
        "4",
    )


def test_conform_orders_casts_and_drops(spark):
    given = spark.createDataFrame([("x", 7, "4.7", 1)], "b string, a bigint, n string, z int")
    found = conform(given, schemas.StructType.fromDDL("a string, b string, n int"))
    assert found.schema.simpleString() == "struct<a:string,b:string,n:int>"
    assert tuple(found.first()) == ("7", "x", 4)
    assert tuple(conform(given, schemas.StructType.fromDDL("b int")).first()) == (None,)


def test_frame_bytes(spark):
    rows = spark.createDataFrame([("é", 10, [1, 2]), (None, 1, None)], "s string, n int, a array<int>")
    assert sizing.frame_bytes(rows).first()["bytes"] == 2 + 2 + len("[1,2]") + 1
    cost = 10 + 2 * (sizing.ROW_COST + 3 * sizing.COLUMN_COST)
    assert sizing.is_small(rows, cost) and not sizing.is_small(rows, cost - 1)
    assert sizing.is_small(rows.limit(0), 0)

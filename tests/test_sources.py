import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from reviewloom import schemas
from reviewloom.sources import bronze, history, parquet

REVIEW = dict.fromkeys(schemas.BRONZE.fieldNames())


def review(**values):
    return tuple({**REVIEW, **values}.values())


def write_bronze(spark, base, folder, *reviews, day="20240130"):
    spark.createDataFrame(list(reviews), schemas.BRONZE).write.parquet(
        f"{base}/appleStore/{folder}/odate={day}"
    )


def globs(base):
    return [f"{base}/appleStore/*_{s}/odate=20240130" for s in ("pf", "pj")]


def test_segments_carry_app_and_segment(spark, tmp_path, rows_of):
    write_bronze(spark, tmp_path, "bank_pf", review(id="1"))
    write_bronze(spark, tmp_path, "my_bank_pj", review(id="2"))
    write_bronze(spark, tmp_path, "bank_pj", review(id="9"), day="20240129")
    found = bronze.read_segments(spark, globs(tmp_path))
    assert found.schema.simpleString() == schemas.BRONZE_WITH_ORIGIN.simpleString()
    assert rows_of(found, "id", "app", "segmento") == [
        ("1", "bank_pf", "pf"),
        ("2", "my_bank_pj", "pj"),
    ]


def test_one_missing_segment_adds_nothing(spark, tmp_path, rows_of):
    write_bronze(spark, tmp_path, "bank_pj", review(id="2"))
    assert rows_of(bronze.read_segments(spark, globs(tmp_path)), "id") == [("2",)]


def test_no_segment_gives_typed_empty_frame(spark, tmp_path):
    found = bronze.read_segments(spark, globs(tmp_path))
    assert found.schema == schemas.BRONZE_WITH_ORIGIN
    assert found.isEmpty()


def test_segment_without_rows(spark, tmp_path, rows_of):
    spark.createDataFrame([], schemas.BRONZE).write.parquet(
        f"{tmp_path}/appleStore/bank_pf/odate=20240130"
    )
    write_bronze(spark, tmp_path, "bank_pj", review(id="2"))
    assert rows_of(bronze.read_segments(spark, globs(tmp_path)), "id") == [("2",)]


def test_only_a_missing_path_is_no_data(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/some")
    with pytest.raises(AnalysisException, match="COLUMN_ALREADY_EXISTS"):
        parquet.scan(spark, f"{tmp_path}/some", StructType.fromDDL("id int, id int"))
    assert parquet.scan(spark, f"{tmp_path}/none", schemas.BRONZE) is None


def silver_row(id_, odate, **values):
    base = dict.fromkeys(schemas.REVIEW_FIELDS)
    return tuple({**base, "id": id_, **values}.values()) + (odate,)


def test_history_before_the_load_date(spark, tmp_path, rows_of):
    rows = [silver_row("1", d, segmento="pf") for d in ("20240128", "20240129", "20240130")]
    path = f"{tmp_path}/silver"
    spark.createDataFrame(rows, schemas.HISTORY).write.partitionBy("odate").parquet(path)
    found = history.read_history(spark, path, "20240130")
    assert rows_of(found, "id", "odate") == [("1", "20240128"), ("1", "20240129")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(odate" in plan


def test_history_older_than_the_segment_column(spark, tmp_path, rows_of):
    path = f"{tmp_path}/silver"
    old = spark.createDataFrame([silver_row("1", "20240128")], schemas.HISTORY).drop("segmento")
    old.write.partitionBy("odate").parquet(path)
    assert rows_of(history.read_history(spark, path, "20240130"), "segmento") == [("NA",)]


def test_first_run_has_typed_empty_history(spark, tmp_path):
    found = history.read_history(spark, f"{tmp_path}/none", "20240130")
    assert found.schema == schemas.HISTORY
    assert found.isEmpty()


def test_folder_without_partitions_is_empty_history(spark, tmp_path):
    assert history.read_history(spark, str(tmp_path), "20240130").isEmpty()

"""Partitioned tables whose load dates are clustered by id, so that joins by id leave them
where they are."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewloom.schemas import KEY, PARTITION
from reviewloom.sources import parquet


def _declared(
    spark: SparkSession, path: str, schema: StructType, buckets: int, key: str, partition_column: str
) -> str:
    """Name of the catalog table over ``path``. Bucket numbers are in the file names, so
    any session that declares the same layout reads what others have written."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != partition_column
    )
    text = f"{path} {columns} {buckets} {key} {partition_column}"
    name = f"reviewloom_{hashlib.md5(text.encode()).hexdigest()[:20]}"
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{partition_column}` string) USING parquet"
        f" PARTITIONED BY (`{partition_column}`) CLUSTERED BY (`{key}`) SORTED BY (`{key}`)"
        f" INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return name


def write_load_date(
    frame: DataFrame,
    path: str,
    load_date: str,
    buckets: int,
    key: str = KEY,
    partition_column: str = PARTITION,
    has_rows: bool | None = None,
) -> bool:
    """Replace the partition ``load_date`` by ``frame``, one file per bucket. Returns whether
    there were rows; without any the rows of an earlier run of the day are cleared.

    A bucket is one task, so choose their number for the largest load date; ``key`` should
    be near unique within one, as a snapshot's ids are.
    """
    rows = frame.drop(partition_column)
    if has_rows is None:
        has_rows = not rows.isEmpty()
    spark = frame.sparkSession
    if not has_rows:
        _clear(spark, rows, path, load_date, buckets, key, partition_column)
        return False
    write_load_dates(
        rows.withColumn(partition_column, F.lit(load_date)), path, buckets, key, partition_column
    )
    return True


def write_load_dates(
    frame: DataFrame, path: str, buckets: int, key: str = KEY, partition_column: str = PARTITION
) -> None:
    """Replace the partitions that occur in ``frame``; others stay."""
    columns = [name for name in frame.columns if name != partition_column]
    rows = frame.select(*columns, F.col(partition_column).cast("string").alias(partition_column))
    spark = frame.sparkSession
    name = _declared(spark, path, rows.drop(partition_column).schema, buckets, key, partition_column)
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting, "static")
    spark.conf.set(setting, "dynamic")
    try:
        rows.repartition(buckets, key).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def _clear(
    spark: SparkSession, rows: DataFrame, path: str, load_date: str, buckets: int, key: str, partition_column: str
) -> None:
    """Remove the files of one load date, if there are any."""
    if parquet.scan(spark, f"{path}/{partition_column}={load_date}", rows.schema) is None:
        return
    name = _declared(spark, path, rows.schema, buckets, key, partition_column)
    rows.limit(0).createOrReplaceTempView(f"{name}_no_rows")
    spark.sql(
        f"INSERT OVERWRITE TABLE {name} PARTITION (`{partition_column}` = '{load_date}')"
        f" SELECT * FROM {name}_no_rows"
    )
    spark.catalog.dropTempView(f"{name}_no_rows")


def read(
    spark: SparkSession,
    path: str,
    schema: StructType,
    buckets: int,
    key: str = KEY,
    partition_column: str = PARTITION,
) -> DataFrame:
    """All load dates; no rows where nothing has been written. ``schema`` without the partition
    column and ``buckets`` must be those that were written."""
    dated = StructType([*schema.fields, StructField(partition_column, StringType(), True)])
    if parquet.scan(spark, path, dated, base_path=path) is None:
        return parquet.empty(spark, dated)
    name = _declared(spark, path, schema, buckets, key, partition_column)
    # other sessions may have written load dates that this one's catalog has not got
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)

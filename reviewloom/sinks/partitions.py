"""One load date's partition of a Parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.operators.standardize import conform
from reviewloom.schemas import PARTITION
from reviewloom.sources import parquet

COMPRESSION = "snappy"


def write_partitioned(
    frame: DataFrame,
    path: str,
    partition_column: str = PARTITION,
    compression: str = COMPRESSION,
) -> None:
    """Replace the partitions that occur in ``frame``; others stay.

    Files hold one partition each and a partition with many rows is spread over
    several tasks. The write is staged and moved at the end, so a job that fails
    leaves the table as it was.
    """
    _checked(frame, path)
    _writer(frame.hint("rebalance", partition_column), compression).partitionBy(
        partition_column
    ).parquet(path)


def write_load_date(
    frame: DataFrame,
    path: str,
    load_date: str,
    schema: StructType | None = None,
    partition_column: str = PARTITION,
    compression: str = COMPRESSION,
    has_rows: bool | None = None,
) -> bool:
    """Write ``frame`` as the partition ``load_date`` of the table at ``path``.

    Returns whether there were rows; a caller that has counted them says so with
    ``has_rows``, which saves a job. Without rows nothing is written, but the
    rows of an earlier run of the same day are cleared.
    """
    _checked(frame, path)
    rows = frame if schema is None else conform(frame, schema)
    if has_rows is None:
        has_rows = not rows.isEmpty()
    if not has_rows:
        _clear(rows.drop(partition_column), f"{path.rstrip('/')}/{partition_column}={load_date}")
        return False
    _writer(rows.withColumn(partition_column, F.lit(load_date)), compression).partitionBy(
        partition_column
    ).parquet(path)
    return True


def _clear(no_rows: DataFrame, folder: str) -> None:
    earlier = parquet.scan(no_rows.sparkSession, folder, no_rows.schema)
    if earlier is not None and not earlier.isEmpty():
        no_rows.limit(0).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(folder)


def _writer(frame: DataFrame, compression: str):
    return (
        frame.write.mode("overwrite")
        .option("compression", compression)
        .option("partitionOverwriteMode", "dynamic")
    )


def _checked(frame: DataFrame, path: str) -> None:
    if not isinstance(frame, DataFrame):
        raise TypeError(f"expected a DataFrame, not {type(frame).__name__}")
    if not path:
        raise ValueError("the target path is empty")

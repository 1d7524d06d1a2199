"""How big a frame is, and which join that allows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# Fixed value: the largest side that is broadcast, in bytes of row text.
BROADCAST_LIMIT = 50 * 1024 * 1024


def _as_text(frame: DataFrame, name: str) -> Column:
    if isinstance(frame.schema[name].dataType, (ArrayType, MapType, StructType)):
        return F.to_json(F.col(name))
    return F.col(name).cast("string")


def row_bytes(frame: DataFrame) -> Column:
    """UTF-8 length of a row's values as text."""
    row = F.concat_ws("", *(_as_text(frame, name) for name in frame.columns))
    return F.octet_length(row).cast("bigint")


def frame_bytes(frame: DataFrame) -> DataFrame:
    """One row, ``bytes``: UTF-8 length of all values as text. Counted on executors."""
    total = F.coalesce(F.sum(row_bytes(frame)), F.lit(0))
    return frame.agg(total.alias("bytes"))


# What a broadcast row takes in memory beside its text: the hashed row, and 8 bytes and a
# null bit for every column.
ROW_COST = 32
COLUMN_COST = 8


def is_small(frame: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether ``frame`` may be broadcast. Runs one aggregate; one row returns."""
    measured = frame.agg(
        F.coalesce(F.sum(row_bytes(frame)), F.lit(0)).alias("bytes"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    cost = ROW_COST + COLUMN_COST * len(frame.columns)
    return measured["bytes"] + measured["rows"] * cost <= limit


def file_bytes(frame: DataFrame) -> int:
    """Size of the files that ``frame``, a plain scan, reads. No column is read."""
    files = frame.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0))).first()[0]

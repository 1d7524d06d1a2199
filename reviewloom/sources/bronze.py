"""Raw reviews of one load date, one folder per app and client segment."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reviewloom import schemas
from reviewloom.functions import paths
from reviewloom.operators import standardize
from reviewloom.sources import layouts, parquet


def read_reviews(
    spark: SparkSession,
    path: str,
    schema: StructType = schemas.BRONZE,
    store: str = paths.STORE,
    segments: tuple[str, ...] = paths.SEGMENTS,
) -> DataFrame:
    """Reviews below ``path`` with ``app`` and ``segmento`` taken from the file path.

    Files may differ in their columns and types: columns they lack are null, others are
    cast, text that is no number to null in an integer column.
    """
    found = layouts.scan(spark, path, schema)
    if not found:
        return parquet.empty(
            spark, StructType(schema.fields + schemas.BRONZE_WITH_ORIGIN.fields[-2:])
        )
    origin = paths.source_path()
    return union_segments(
        frame.select(
            *standardize.conformed(frame, schema),
            paths.app_of(origin, store).alias("app"),
            paths.segment_of(origin, segments).alias("segmento"),
        )
        for frame in found
    )


def union_segments(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all segments, columns matched by name. One frame passes through."""
    return reduce(DataFrame.unionByName, frames)


def read_segments(spark: SparkSession, globs: Iterable[str], **options) -> DataFrame:
    """One frame for several segment globs; segments without data add no rows."""
    return union_segments(read_reviews(spark, glob, **options) for glob in globs)

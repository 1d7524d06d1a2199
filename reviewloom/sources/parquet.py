"""Parquet scan that tolerates a missing path, and nothing else."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows of ``schema``; known to be empty when the plan is made."""
    return spark.range(0).select(
        *(F.lit(None).cast(field.dataType).alias(field.name) for field in schema.fields)
    )


def _matches(spark: SparkSession, path: str) -> bool:
    """Whether a folder or glob finds anything, as the file system of the path says."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def scan(
    spark: SparkSession,
    path: str,
    schema: StructType,
    base_path: str | None = None,
) -> DataFrame | None:
    """Scan ``path`` (a folder or glob); None when nothing matches it.

    Any other analysis error, such as an unreadable schema, is raised.
    """
    if not _matches(spark, path):
        return None
    reader = spark.read.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None

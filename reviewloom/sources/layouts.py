"""Parquet files of several layouts read as one."""

from __future__ import annotations

import posixpath

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from reviewloom.sources import parquet


def with_default(schema: StructType, name: str, default: str) -> StructType:
    """``schema`` in which files that lack the text column ``name`` read as ``default``.

    That is Spark's column default for columns added after a file was written. A null in
    a file that has the column stays null.
    """
    quoted = "'" + default.replace("'", "\\'") + "'"
    marks = {"EXISTS_DEFAULT": quoted, "CURRENT_DEFAULT": quoted}
    return StructType(
        [
            StructField(f.name, f.dataType, True, {**f.metadata, **marks}) if f.name == name else f
            for f in schema.fields
        ]
    )


def _merged(spark: SparkSession, paths: list[str]) -> StructType | None:
    """The layout of all files at ``paths``, None if they do not agree on a type.

    Spark reads the footers in one job on the executors.
    """
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
        return None


def _stored_as(found: StructType, wanted: StructType) -> StructType:
    """Wanted columns with the types that the files have; those they lack as wanted."""
    types = {f.name: f.dataType for f in found.fields}
    return StructType(
        [StructField(f.name, types.get(f.name, f.dataType), True, f.metadata) for f in wanted.fields]
    )


def scan(spark: SparkSession, path: str, schema: StructType) -> list[DataFrame]:
    """Frames that together hold the files below ``path``, each with the columns of
    ``schema`` in the types that its files have, so that reading never fails on a type.

    One frame where all files agree. Else folders are grouped by layout, and only in
    folders whose own files disagree single files. Empty if nothing matches ``path``.
    """
    found = parquet.scan(spark, path, schema)
    if found is None:
        return []
    files = found.inputFiles()
    if not files:
        return [found]
    groups: dict[str, tuple[StructType, list[str]]] = {}

    def add(layout: StructType, places: list[str]) -> None:
        stored = _stored_as(layout, schema)
        groups.setdefault(stored.json(), (stored, []))[1].extend(places)

    whole = _merged(spark, [path])
    if whole is not None:
        add(whole, [path])
    else:
        folders: dict[str, list[str]] = {}
        for file in files:
            folders.setdefault(posixpath.dirname(file), []).append(file)
        for folder, members in sorted(folders.items()):
            layout = _merged(spark, [folder])
            if layout is not None:
                add(layout, [folder])
            else:
                for file in members:
                    add(spark.read.parquet(file).schema, [file])
    return [spark.read.schema(stored).parquet(*places) for stored, places in groups.values()]

"""Metrics documents, appended as JSON lines to a table partitioned by index."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KINDS = ("success", "fail")


def parse_documents(frame: DataFrame, schema: StructType | str, column: str = "document"):
    """The documents as structs; malformed JSON fails the job."""
    return frame.select(
        F.from_json(F.col(column), schema, {"mode": "FAILFAST"}).alias("document")
    ).select("document.*")


def save_documents(documents: DataFrame, path: str, index: str) -> None:
    """Append ``document`` (JSON text) rows under ``index``. Malformed JSON is refused."""
    # parse_json raises on malformed text and is only used for that
    well_formed = F.parse_json("document").isNotNull()
    one_line = F.translate("document", "\r\n", "  ")
    checked = documents.select(
        F.lit(index).alias("index"), F.when(well_formed, one_line).alias("document")
    )
    checked.write.mode("append").partitionBy("index").text(path)


def save_run(
    kind: str,
    path: str,
    index: str,
    documents: DataFrame | None = None,
    error: BaseException | None = None,
) -> None:
    """Save the documents of one run: ``success`` needs documents, ``fail`` also an error."""
    kind = kind.lower()
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}: {kind}")
    if kind == "fail" and error is None:
        raise ValueError("a failed run needs its error")
    if documents is None:
        raise ValueError("there is no document to save")
    save_documents(documents, path, index)


def read_documents(spark: SparkSession, path: str, index: str | None = None) -> DataFrame:
    """Saved documents as ``index`` and JSON text ``document``."""
    stored = spark.read.schema("value string, index string").text(path)
    found = stored.select("index", F.col("value").alias("document"))
    return found if index is None else found.filter(F.col("index") == index)

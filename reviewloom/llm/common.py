"""What several of the operators share: words, batches and per-text functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII blanks. Same text for Java and Python.
WORD = r"[^\x20\x09-\x0D]+"
words = re.compile(WORD).findall
has_word = re.compile(WORD).search

# Rows and bytes that go to a Python worker at once. Long texts make a batch large, so
# the rows are few; a batch always holds whole rows.
BATCH_ROWS = 500
BATCH_BYTES = 16 * 1024 * 1024


def bounded_batches(spark: SparkSession) -> None:
    """Keep what a Python worker holds at once small, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_text(make: Callable[[], Callable[[str], tuple]], schema: str) -> Callable[[Column], Column]:
    """A column function that maps each text (null: empty) to a struct of ``schema``.

    ``make`` runs once per Python worker and task; what it returns is called with every
    text. The other columns of the rows stay in the JVM.
    """
    names = [part.split()[0] for part in schema.split(",")]

    def of_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        measure = make()
        for batch in batches:
            yield pd.DataFrame([measure(text) for text in batch], columns=names)

    return lambda text: F.pandas_udf(of_batches, schema)(F.coalesce(text, F.lit("")))

"""Frame layouts. Column names are fixed values: stored tables depend on them."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType(), True) for name in names]


KEY = "id"
PARTITION = "odate"

# A changed value in one of these makes the earlier version worth keeping.
# The order is the precedence used when naming the change.
TRACKED = ("title", "content", "im_version", "im_rating")

# What is kept of an earlier version, in stored field order.
PAYLOAD = ("title", "content", "app", "segmento", "im_version", "im_rating")

# A review is complete when all of these are present.
REQUIRED = ("id", "name_client", "content")

# Columns whose nulls are reported.
CRITICAL = ("id", "content", "im_rating", "im_version")

BRONZE = StructType(
    _strings(
        "author_name",
        "author_uri",
        "content",
        "content_attributes_label",
        "content_attributes_term",
        "id",
    )
    + [StructField("im_rating", IntegerType(), True)]
    + _strings("im_version")
    + [
        StructField("im_votecount", IntegerType(), True),
        StructField("im_votesum", IntegerType(), True),
    ]
    + _strings("link_attributes_href", "link_attributes_related", "title", "updated")
)

# Bronze plus the two attributes read off the file path.
BRONZE_WITH_ORIGIN = StructType(BRONZE.fields + _strings("app", "segmento"))

HISTORY_ENTRY = StructType(_strings(*PAYLOAD))

REVIEW_FIELDS = (
    "id",
    "name_client",
    "app",
    "im_version",
    "im_rating",
    "title",
    "content",
    "updated",
    "segmento",
)

SILVER = StructType(
    _strings(*REVIEW_FIELDS)
    + [StructField("historical_data", ArrayType(HISTORY_ENTRY, True), True)]
)

# What the merge needs of earlier silver partitions. The nested history of
# those partitions is not read: it is rebuilt from the versions themselves.
HISTORY = StructType(_strings(*REVIEW_FIELDS, PARTITION))

QUARANTINE = StructType(
    SILVER.fields + [StructField("reasons", ArrayType(StringType(), True), True)]
)

REPORT = StructType(
    [
        StructField("check", StringType(), True),
        StructField("status", BooleanType(), True),
        StructField("code", IntegerType(), True),
        StructField("message", StringType(), True),
        StructField("total_records", LongType(), True),
    ]
)

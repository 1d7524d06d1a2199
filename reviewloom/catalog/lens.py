"""Test tables seen as reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.schemas import KEY, PARTITION

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _rated(spark: SparkSession, folder: str, **columns: Column) -> DataFrame:
    """Document columns with the label's quality as rating, null where there is none.

    The columns are computed before the join, so that texts are only joined
    where they are wanted themselves.
    """
    documents = table(spark, folder, "documents").withColumns(columns)
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("im_rating"))
    return documents.select("doc_id", *columns).join(labels, "doc_id", "left").drop("doc_id")


def raw_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as bronze reviews, rated by their label where they have one."""
    none = F.lit(None)
    return _rated(
        spark,
        folder,
        id=F.col("doc_id").cast("string"),
        author_name=F.col("source"),
        title=F.substring_index("text", ".", 1),
        content=F.col("text"),
        im_version=F.col("n_chars").cast("string"),
        updated=none.cast("string"),
        author_uri=none.cast("string"),
        im_votecount=none.cast("int"),
        im_votesum=none.cast("int"),
        app=F.lit("documents"),
        content_attributes_label=none.cast("string"),
        content_attributes_term=none.cast("string"),
        segmento=F.col("lang"),
    )


def checked_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """The same reviews, whole, for the checks, with a digest of the text as key.

    Ids are unique in the documents and texts are not, so the text is what can repeat.
    """
    reviews = raw_reviews(spark, folder)
    return reviews.select(
        "id",
        F.col("author_name").alias("name_client"),
        "app",
        "im_version",
        F.col("im_rating").cast("string").alias("im_rating"),
        "title",
        "content",
        "segmento",
        F.sha2("content", 256).alias("text_key"),
    )


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Events as daily snapshots: each user's last event of each day."""
    return _snapshots(table(spark, folder, "events"))


def new_and_earlier(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Snapshots of the last day in the data, and those of all days before."""
    events = table(spark, folder, "events")
    days = _snapshots(events)
    last_day = events.agg(F.to_date(F.max("ts"))).scalar()
    return (
        days.filter(F.col(PARTITION) == last_day).drop(PARTITION),
        days.filter(F.col(PARTITION) < last_day),
    )


def _snapshots(events: DataFrame) -> DataFrame:
    last = F.max(F.struct("event_id", "event_type", "props", "value"))
    return (
        events.groupBy("user_id", F.to_date("ts").alias(PARTITION))
        .agg(last.alias("last"))
        .select(
            F.col("user_id").cast("string").alias(KEY),
            F.concat(F.lit("USER "), F.col("user_id").cast("string")).alias("name_client"),
            F.lit("events").alias("app"),
            F.lit(None).cast("string").alias("im_version"),
            F.floor("last.value").cast("string").alias("im_rating"),
            F.col("last.event_type").alias("title"),
            F.col("last.props").alias("content"),
            F.col(PARTITION).cast("string").alias("updated"),
            F.lit("pf").alias("segmento"),
            PARTITION,
        )
    )

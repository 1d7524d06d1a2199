"""Catalog queries: ``(spark, folder) -> DataFrame``, over whole tables.

Results hold plain columns only: arrays come as joined text, dates as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from reviewloom import schemas, session
from reviewloom.catalog import lens
from reviewloom.functions import formats, paths, text
from reviewloom.operators import bitmaps, joins, ledger, merge, quality, sizing
from reviewloom.operators.standardize import conform, standardize_reviews
from reviewloom.plans import daily_run as daily
from reviewloom.plans import documents, lake, stage_metrics
from reviewloom.plans.config import RunConfig
from reviewloom.sinks import buckets, metrics, partitions
from reviewloom.sources import bronze, history, parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Key and required columns of the document reviews, see the lens.
TEXT_KEY = "text_key"
RATED = ("id", "name_client", "im_rating")

# Files a load date that a clustered table is written in.
BUCKETS = 8

STARTED = datetime(2024, 1, 30, 10, 0, 0, tzinfo=timezone.utc)
ENDED = datetime(2024, 1, 30, 10, 1, 30, tzinfo=timezone.utc)
STAMPED = datetime(2024, 1, 30, 10, 1, 31, 250000, tzinfo=timezone.utc)


def query(function):
    QUERIES[function.__name__] = function
    return function


def _moment(value: datetime):
    return F.lit(value).cast("timestamp")


# Sources ---------------------------------------------------------------------


@query
def union_segments(spark: SparkSession, folder: str) -> DataFrame:
    reviews = lens.raw_reviews(spark, folder)
    reordered = reviews.select(*reversed(reviews.columns))
    return bronze.union_segments(
        [reviews.filter("segmento = 'en'"), reordered.filter("segmento <> 'en'")]
    )


@query
def empty_source(spark: SparkSession, folder: str) -> DataFrame:
    missing = bronze.read_reviews(spark, f"{folder}/appleStore/*_pf/odate=20240130")
    present = lens.raw_reviews(spark, folder)
    return bronze.union_segments([missing.select(*present.columns), present])


@query
def path_attributes(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("page_id") % 4
    suffix = (
        F.when(kind == 0, "_pf").when(kind == 1, "_my_pj").when(kind == 2, "_fp").otherwise("")
    )
    path = F.concat(
        F.lit("/lake/bronze/appleStore/"),
        F.regexp_extract("url", "^https?://([^/?#]+)", 1),
        suffix,
        F.lit("/odate=20240130/part-0.parquet"),
    )
    pages = lens.table(spark, folder, "pages").select("page_id", path.alias("path"))
    return pages.select(
        "page_id",
        paths.app_of(F.col("path")).alias("app"),
        paths.segment_of(F.col("path")).alias("segmento"),
    )


@query
def file_lineage(spark: SparkSession, folder: str) -> DataFrame:
    return lens.table(spark, folder, "orders").select(
        "o_orderkey",
        F.regexp_extract(paths.source_path(), r"/([^/]+)\.parquet(/|$)", 1).alias("source_table"),
    )


@query
def history_partitions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _stored_history(spark, folder)
        .select(
            "id",
            "title",
            "content",
            "im_rating",
            "segmento",
            F.to_date(schemas.PARTITION, "yyyyMMdd").cast("string").alias(schemas.PARTITION),
        )
    )


@query
def history_default(spark: SparkSession, folder: str) -> DataFrame:
    """History whose files have no ``segmento`` yet."""
    return _stored_history(spark, folder, without=("segmento",)).select("id", "title", "segmento")


def _stored_history(spark: SparkSession, folder: str, without: tuple[str, ...] = ()) -> DataFrame:
    """The snapshots written as a table by load date and read back up to the last day."""
    stored = session.scratch_folder(spark)
    frame = lens.snapshots(spark, folder).drop(*without)
    partitions.write_partitioned(
        frame.withColumn(schemas.PARTITION, F.date_format(schemas.PARTITION, "yyyyMMdd")), stored
    )
    last = lens.table(spark, folder, "events").agg(F.max("ts")).first()[0]
    return history.read_history(spark, stored, last.strftime("%Y%m%d"))


# Projections -----------------------------------------------------------------


@query
def standardize_text(spark: SparkSession, folder: str) -> DataFrame:
    return lens.table(spark, folder, "documents").select(
        "doc_id",
        text.shout(F.col("text")).alias("content"),
        text.shout(F.col("source")).alias("name_client"),
    )


@query
def standardize_reviews_columns(spark: SparkSession, folder: str) -> DataFrame:
    return standardize_reviews(lens.raw_reviews(spark, folder)).select(
        "id", "name_client", "title", "im_version", "im_rating", "app", "segmento", "content"
    )


QUERIES["standardize_reviews"] = QUERIES.pop("standardize_reviews_columns")


@query
def conform_schema(spark: SparkSession, folder: str) -> DataFrame:
    layout = StructType(
        [
            StructField("id", StringType()),
            StructField("im_rating", IntegerType()),
            StructField("im_version", IntegerType()),
            StructField("title", IntegerType()),
            StructField("segmento", StringType()),
            StructField("content", StringType()),
        ]
    )
    return conform(lens.raw_reviews(spark, folder), layout).withColumn(
        schemas.PARTITION, F.lit("20240130")
    )


# Merge -----------------------------------------------------------------------


def _sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    new, old = lens.new_and_earlier(spark, folder)
    odate = F.col(schemas.PARTITION).cast("string").alias(schemas.PARTITION)
    return (
        joins.prefixed(new.select(*schemas.REVIEW_FIELDS), "new", "id"),
        joins.prefixed(old.select(*schemas.REVIEW_FIELDS, odate), "old", "id"),
    )


def _outer_columns(pairs: DataFrame) -> DataFrame:
    values = [name for name in schemas.REVIEW_FIELDS if name != schemas.KEY]
    return pairs.select(
        "id", *(f"{side}_{name}" for side in ("new", "old") for name in values), "old_odate"
    )


@query
def outer_merge(spark: SparkSession, folder: str) -> DataFrame:
    new, old = _sides(spark, folder)
    return _outer_columns(new.join(old, "id", "full_outer"))


@query
def merge_decomposed(spark: SparkSession, folder: str) -> DataFrame:
    new, old = _sides(spark, folder)
    return _outer_columns(joins.outer_in_parts(old, new, "id"))


@query
def merge_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    """The history is measured and only broadcast when it is small."""
    new, old = _sides(spark, folder)
    return _outer_columns(joins.outer_in_parts(new, old, "id", small=sizing.is_small(old)))


@query
def salted_outer(spark: SparkSession, folder: str) -> DataFrame:
    new, old = _sides(spark, folder)
    return _outer_columns(joins.outer_in_parts(old, new, "id", salted=True))


@query
def salted_join(spark: SparkSession, folder: str) -> DataFrame:
    events = lens.table(spark, folder, "events").select(
        "event_id", F.col("user_id").cast("string").alias("id")
    )
    new, _ = lens.new_and_earlier(spark, folder)
    new = new.select("id", "title")
    return joins.salted_join(events, new, "id").select("event_id", "id", "title")


@query
def change_flags(spark: SparkSession, folder: str) -> DataFrame:
    new, old = lens.new_and_earlier(spark, folder)
    pairs = joins.prefixed(new, "new", "id").join(joins.prefixed(old, "old", "id"), "id")
    return pairs.select(
        "id",
        F.col("old_odate").cast("string").alias("odate"),
        merge.change_label().alias("changed"),
        merge.change_flag().alias("is_change"),
    )


def _change_columns(changes: DataFrame) -> DataFrame:
    return changes.select(
        "id", F.col("first_seen").cast("string").alias("first_seen"), "title", "content", "im_rating"
    )


@query
def change_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _change_columns(merge.change_rows(*lens.new_and_earlier(spark, folder)))


@query
def change_rows_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    new, old = lens.new_and_earlier(spark, folder)
    small = sizing.is_small(new.select(schemas.KEY, *schemas.TRACKED))
    return _change_columns(merge.change_rows(new, old, small))


@query
def change_history(spark: SparkSession, folder: str) -> DataFrame:
    new, old = lens.new_and_earlier(spark, folder)
    small = sizing.is_small(new.select(schemas.KEY, *schemas.TRACKED))
    nested = merge.nest_changes(merge.change_rows(new, old, small))
    return nested.select(
        "id",
        merge.entries_text(F.col("historical_data")).alias("history"),
        F.size("historical_data").cast("bigint").alias("versions"),
    )


@query
def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    _, old = lens.new_and_earlier(spark, folder)
    return merge.latest_rows(old).select(
        "id", "title", "content", "im_rating", "updated"
    )


_CURRENT = ("id", "name_client", "title", "content", "im_rating", "updated")


@query
def current_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    new, old = lens.new_and_earlier(spark, folder)
    return merge.current_snapshot(new, merge.latest_rows(old)).select(*_CURRENT)


@query
def snapshot_merge(spark: SparkSession, folder: str) -> DataFrame:
    merged = merge.merge_snapshots(*lens.new_and_earlier(spark, folder))
    return merged.select(
        *_CURRENT, merge.entries_text(F.col("historical_data")).alias("history")
    )


@query
def change_rows_reduced(spark: SparkSession, folder: str) -> DataFrame:
    """The history reduced by a bitmap of the new ids, as where they fit no broadcast."""
    new, old = lens.new_and_earlier(spark, folder)
    return _change_columns(merge.change_rows(new, bitmaps.likely_rows(old, new, schemas.KEY)))


def _kept_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of all days before the last: built from all but two of them, brought forward
    by those two one at a time, and stored by load date and clustered by id."""
    path = session.scratch_folder(spark)
    _, old = lens.new_and_earlier(spark, folder)
    old = session.store(old.withColumn(schemas.PARTITION, F.date_format(schemas.PARTITION, "yyyyMMdd")))
    days = old.select(schemas.PARTITION).distinct().orderBy(F.desc(schemas.PARTITION)).limit(2)
    last = sorted(r[0] for r in days.collect())
    known = ledger.versions_of(old.filter(~F.col(schemas.PARTITION).isin(last)))
    for day in last:
        known = session.store(known)
        rows = old.filter(F.col(schemas.PARTITION) == day)
        entries = ledger.known_versions(known, rows.select(schemas.KEY))
        fresh = ledger.new_versions(rows, entries).withColumn(schemas.PARTITION, F.lit(day))
        known = known.unionByName(fresh)
    buckets.write_load_dates(known, path, BUCKETS)
    return buckets.read(spark, path, ledger.LEDGER, BUCKETS)


@query
def ledger_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _kept_ledger(spark, folder).select(
        "id",
        "title",
        "content",
        "im_rating",
        F.to_date(schemas.PARTITION, "yyyyMMdd").cast("string").alias("first_seen"),
    )


@query
def ledger_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The last day merged by newest snapshot and ledger: what all snapshots give."""
    new, old = lens.new_and_earlier(spark, folder)
    new = session.store(new)
    known = ledger.known_versions(_kept_ledger(spark, folder), new.select(schemas.KEY))
    newest = merge.latest_rows(session.store(old))
    merged = ledger.merge_with_ledger(new, newest, session.store(known))
    return merged.select(
        *_CURRENT, merge.entries_text(F.col("historical_data")).alias("history")
    )


@query
def bucketed_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The newest rows stored clustered by id and merged where they lie."""
    path = session.scratch_folder(spark)
    new, old = lens.new_and_earlier(spark, folder)
    newest = merge.latest_rows(session.store(old))
    buckets.write_load_date(newest, path, "20240129", BUCKETS)
    stored = buckets.read(spark, path, newest.schema, BUCKETS).drop(schemas.PARTITION)
    return merge.current_snapshot(new, stored).select(*_CURRENT)


# Quality ---------------------------------------------------------------------


@query
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    digests = lens.table(spark, folder, "documents").select(F.sha2("text", 256).alias(TEXT_KEY))
    return quality.duplicate_keys(digests, TEXT_KEY)


@query
def duplicate_records(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents whose text repeats."""
    found = lens.table(spark, folder, "documents").withColumn(TEXT_KEY, F.sha2("text", 256))
    return quality.duplicate_records(found, TEXT_KEY)


@query
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_counts(lens.checked_reviews(spark, folder))


@query
def rating_type_check(spark: SparkSession, folder: str) -> DataFrame:
    part = lens.table(spark, folder, "part").select(
        "p_partkey",
        F.col("p_name").alias("name"),
        F.concat(F.lit(" "), F.col("p_size").cast("string")).alias("size"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.concat(F.col("p_partkey").cast("string"), F.lit("0000000000")).alias("key"),
    )
    texts = part.unpivot(["p_partkey"], ["name", "size", "price", "key"], "field", "im_rating")
    return texts.select(
        "p_partkey",
        "field",
        text.whole_number(F.col("im_rating")).alias("number"),
        quality.bad_rating().alias("bad"),
    )


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_counts(lens.checked_reviews(spark, folder), TEXT_KEY, RATED)


@query
def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validation_report(_counts(spark, folder))


@query
def check_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return quality.check_rollup(validation_report(spark, folder))


@query
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Whole rejected reviews and why."""
    rejected = quality.quarantine(lens.checked_reviews(spark, folder), TEXT_KEY, RATED)
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


@query
def valid_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Whole reviews that pass every check."""
    return quality.valid_rows(lens.checked_reviews(spark, folder), TEXT_KEY, RATED)


@query
def except_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, their lines as an array too, without those that equal a labelled one."""
    found = lens.table(spark, folder, "documents").withColumn("lines", F.split("text", "\n"))
    labelled = found.join(lens.table(spark, folder, "labels").select("doc_id"), "doc_id")
    columns = ["text", "lang", "source", "n_chars", "lines"]
    rest = quality.except_rows(found.select(*columns), labelled.select(*columns))
    return rest.withColumn("lines", F.array_join("lines", "|"))


@query
def frame_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return sizing.frame_bytes(lens.table(spark, folder, "documents"))


@query
def sample(spark: SparkSession, folder: str) -> DataFrame:
    return quality.sample(lens.raw_reviews(spark, folder))


# Metrics ---------------------------------------------------------------------


def _rounded(name: str):
    return F.round(name, 6).alias(name)


@query
def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return documents.quality_share(_counts(spark, folder)).select(
        "valid",
        _rounded("valid_percentage"),
        "invalid",
        _rounded("invalid_percentage"),
        "total_records",
    )


def _languages(spark: SparkSession, folder: str) -> DataFrame:
    return quality.segment_names(lens.table(spark, folder, "documents"), "lang")


@query
def segment_label(spark: SparkSession, folder: str) -> DataFrame:
    return _languages(spark, folder).select(
        formats.label_of(F.col("names")).alias("type_client")
    )


@query
def metrics_document(spark: SparkSession, folder: str) -> DataFrame:
    saved = documents.success_document(
        _counts(spark, folder),
        _languages(spark, folder).scalar(),
        "run-1",
        _moment(STARTED),
        _moment(ENDED),
        _moment(STAMPED),
        F.create_map(F.lit("numStages"), F.lit("3"), F.lit("numTasks"), F.lit("12")),
    )
    share = "struct<count: bigint, percentage: double>"
    check = "struct<message: string, status: boolean, code: int>"
    layout = f"""
        application_id string, owner struct<sigla: string, projeto: string, layer_lake: string>,
        valid_data {share}, invalid_data {share}, total_records bigint,
        total_processing_time string, stages map<string, string>,
        validation_results struct<
            duplicate_check: {check}, null_check: {check}, type_consistency_check: {check}>,
        success_count bigint, error_count bigint, type_client string,
        source struct<app: string, search: string>,
        _ts struct<start_ts: string, end_ts: string>, timestamp string"""
    parsed = metrics.parse_documents(saved, layout)
    checks = [
        F.col(f"validation_results.{name}.{part}").alias(f"{name}_{part}")
        for name in quality.CHECKS
        for part in ("message", "status", "code")
    ]
    return parsed.select(
        "application_id",
        "owner.*",
        F.col("valid_data.count").alias("valid_count"),
        F.col("invalid_data.count").alias("invalid_count"),
        F.round("valid_data.percentage", 6).alias("valid_percentage"),
        F.round("invalid_data.percentage", 6).alias("invalid_percentage"),
        "total_records",
        "total_processing_time",
        F.array_join(
            F.transform(F.map_entries("stages"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
        ).alias("stages"),
        *checks,
        "success_count",
        "error_count",
        "type_client",
        F.col("source.app").alias("source_app"),
        F.col("source.search").alias("source_search"),
        F.col("_ts.start_ts").alias("start_ts"),
        F.col("_ts.end_ts").alias("end_ts"),
        "timestamp",
    )


@query
def metrics_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    per_client = (
        lens.table(spark, folder, "documents")
        .groupBy(F.col("lang").alias("client"))
        .agg(F.count(F.lit(1)).alias("total"))
    )
    stored = session.scratch_folder(spark)
    metrics.save_run(
        "success",
        stored,
        "datametrics",
        per_client.select(F.to_json(F.struct("client", "total")).alias("document")),
    )
    found = metrics.read_documents(spark, stored, "datametrics")
    parsed = F.from_json("document", "client string, total bigint", {"mode": "FAILFAST"})
    return found.select("index", parsed.alias("d")).select("index", "d.client", "d.total")


@query
def failure_document(spark: SparkSession, folder: str) -> DataFrame:
    saved = documents.failure_document(
        _languages(spark, folder), "no space left", _moment(STAMPED)
    )
    layout = """
        timestamp string, layer string, project string, job string, priority string,
        tower string, client array<string>, error string"""
    return metrics.parse_documents(saved, layout).select(
        "layer",
        "job",
        "priority",
        F.array_join("client", ",").alias("clients"),
        "error",
        "timestamp",
    )


@query
def stage_report_kv(spark: SparkSession, folder: str) -> DataFrame:
    """Report lines made of every event: pairs of both kinds, headings and blank lines."""
    kind = F.col("event_type")
    line = (
        F.when(kind == "error", F.concat(F.lit("Scheduling mode = "), "props"))
        .when(kind == "view", "   ")
        .when(kind == "click", F.concat_ws(" => ", "event_type", "props"))
        .otherwise(F.concat(F.lit("  "), F.concat_ws(" = ", "event_type", "props")))
    )
    lines = lens.table(spark, folder, "events").select("event_id", line.alias("line"))
    return stage_metrics.parse_report(lines, keep=("event_id",))


# Sinks and the whole run -----------------------------------------------------


def _two_days(spark: SparkSession, folder: str) -> tuple[RunConfig, RunConfig]:
    """Raw files of two load dates.

    The first day has all documents, some without an author. The second has the labelled ones
    with the label as rating, toxic ones twice.
    """
    base = session.scratch_folder(spark)
    first_day = RunConfig(
        env="pro",
        as_of="20240101",
        bronze=f"{base}/bronze",
        silver=f"{base}/silver",
        quarantine=f"{base}/quarantine",
        metrics=f"{base}/metrics",
    )
    reviews = lens.raw_reviews(spark, folder).withColumn(
        "author_name", F.when(F.col("im_version").cast("int") % 7 != 0, F.col("author_name"))
    )
    first = reviews.withColumn("im_rating", F.col("im_version").cast("int") % 5 + 1)
    _load_bronze(first, first_day)
    labels = lens.table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("id"),
        F.explode(F.sequence(F.lit(0), F.col("toxic"))).alias("copy"),
    )
    second = reviews.withColumn("im_rating", F.col("im_rating") + 1).join(labels, "id")
    second_day = replace(first_day, as_of="20240102")
    _load_bronze(second.drop("copy"), second_day)
    return first_day, second_day


def _stored_day(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Silver and quarantine of a load date."""
    ratings = F.array_join(F.transform("historical_data", lambda e: e["im_rating"]), ",")
    columns = ["id", "app", "segmento", "im_rating", ratings.alias("history")]
    valid = lake.day_of(spark, config.silver_path, schemas.SILVER, config.as_of)
    invalid = lake.day_of(spark, config.quarantine_path, schemas.QUARANTINE, config.as_of)
    return valid.select(*columns, F.lit("valid").alias("reasons")).unionByName(
        invalid.select(*columns, F.array_join("reasons", ",").alias("reasons"))
    )


@query
def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two load dates run end to end; silver and quarantine of the second."""
    first, second = _two_days(spark, folder)
    daily.run(spark, first)
    daily.run(spark, second)
    return _stored_day(spark, second)


@query
def late_day(spark: SparkSession, folder: str) -> DataFrame:
    """The first load date is run after the second, which is then brought up to date."""
    first, second = _two_days(spark, folder)
    daily.run(spark, second)
    daily.run(spark, first)
    return _stored_day(spark, second)


@query
def failed_run(spark: SparkSession, folder: str) -> DataFrame:
    """The document of a run whose silver has no file system: its batch is read, the failure
    is recorded and raised."""
    first, _ = _two_days(spark, folder)
    broken = replace(first, silver="nowhere://lake/silver")
    try:
        daily.run(spark, broken)
    except Exception as error:
        raised = type(error).__name__
    else:
        raised = "nothing"
    saved = metrics.read_documents(spark, broken.metrics, broken.fail_index)
    layout = "layer string, project string, job string, priority string, client array<string>, error string"
    return saved.select("index", F.from_json("document", layout).alias("d")).select(
        "index",
        "d.layer",
        "d.project",
        "d.job",
        "d.priority",
        F.array_join("d.client", ",").alias("clients"),
        F.col("d.error").contains("nowhere").alias("says_why"),
        F.lit(raised != "nothing").alias("raised"),
    )


def _load_bronze(reviews: DataFrame, config: RunConfig) -> None:
    """English reviews as one segment, the others as the other."""
    for segment, chosen in (("pf", F.col("segmento") == "en"), ("pj", F.col("segmento") != "en")):
        rows = conform(
            reviews.filter(chosen)
            .withColumn("link_attributes_href", F.lit(None).cast("string"))
            .withColumn("link_attributes_related", F.lit(None).cast("string")),
            schemas.BRONZE,
        )
        rows.write.parquet(
            f"{config.bronze}/{config.store}/docs_{segment}/odate={config.as_of}",
            compression=session.COMPACT,
        )


@query
def partition_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """All events written by day, then the last day written again with corrected rows."""
    events = lens.table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.date_format("ts", "yyyyMMdd").alias(schemas.PARTITION),
    )
    stored = session.scratch_folder(spark)
    partitions.write_partitioned(events.withColumn("load", F.lit("first")), stored)
    last = events.agg(F.max(schemas.PARTITION)).first()[0]
    again = events.filter(F.col(schemas.PARTITION) == last).withColumn("load", F.lit("corrected"))
    partitions.write_load_date(again.drop(schemas.PARTITION), stored, last)
    layout = "event_id bigint, user_id bigint, event_type string, load string, odate string"
    return parquet.scan(spark, stored, StructType.fromDDL(layout), base_path=stored)

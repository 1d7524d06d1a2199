"""Metrics documents of a run, as one-row frames of JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import formats
from reviewloom.operators import quality
from reviewloom.plans.config import Labels

UNKNOWN_CLIENT = "UNKNOWN_CLIENT"


def quality_share(counts: DataFrame) -> DataFrame:
    """Valid and invalid rows with their percentages, from a ``quality_counts`` row."""
    return counts.select(
        "valid",
        formats.percent_of(F.col("valid"), F.col("total_records")).alias("valid_percentage"),
        "invalid",
        formats.percent_of(F.col("invalid"), F.col("total_records")).alias("invalid_percentage"),
        "total_records",
    )


def _share(part: str, total: Column) -> Column:
    return F.struct(
        F.col(part).alias("count"), formats.percent_of(F.col(part), total).alias("percentage")
    )


def success_document(
    counts: DataFrame,
    segments: Column,
    application_id: str,
    started: Column,
    ended: Column,
    stamped: Column,
    stages: Column | None = None,
    labels: Labels = Labels(),
) -> DataFrame:
    """One ``document`` from a ``quality_counts`` row, which may carry ``written_total``,
    the rows of both tables, where that differs from the rows that were checked."""
    total = F.col("written_total" if "written_total" in counts.columns else "total_records")
    checks = quality.check_structs()
    passed = sum(check["status"].cast("int") for check in checks)
    document = F.struct(
        F.lit(application_id).alias("application_id"),
        F.struct(
            F.lit(labels.sigla).alias("sigla"),
            F.lit(labels.projeto).alias("projeto"),
            F.lit(labels.layer_lake).alias("layer_lake"),
        ).alias("owner"),
        _share("valid", total).alias("valid_data"),
        _share("invalid", total).alias("invalid_data"),
        total.alias("total_records"),
        formats.minutes_between(started, ended).alias("total_processing_time"),
        (F.create_map().cast("map<string,string>") if stages is None else stages).alias("stages"),
        F.struct(
            *(
                F.struct(
                    check["message"].alias("message"),
                    check["status"].alias("status"),
                    check["code"].alias("code"),
                ).alias(name)
                for name, check in zip(quality.CHECKS, checks)
            )
        ).alias("validation_results"),
        passed.alias("success_count"),
        (F.lit(len(checks)) - passed).alias("error_count"),
        formats.label_of(segments).alias("type_client"),
        F.struct(F.lit(labels.app).alias("app"), F.lit(labels.search).alias("search")).alias(
            "source"
        ),
        F.struct(
            formats.to_seconds_text(started).alias(f"{labels.ts_prefix}start_ts"),
            formats.to_seconds_text(ended).alias(f"{labels.ts_prefix}end_ts"),
        ).alias("_ts"),
        formats.to_millis_text(stamped).alias("timestamp"),
    )
    return counts.select(F.to_json(document).alias("document"))


def failure_document(
    clients: DataFrame,
    error: str,
    stamped: Column,
    labels: Labels = Labels(),
) -> DataFrame:
    """One ``document`` for a failed run. ``clients`` is one row with an array ``names``."""
    names = F.when(F.size("names") > 0, F.col("names")).otherwise(F.array(F.lit(UNKNOWN_CLIENT)))
    document = F.struct(
        formats.to_millis_text(stamped).alias("timestamp"),
        F.lit(labels.layer_lake).alias("layer"),
        F.lit(labels.projeto).alias("project"),
        F.lit(labels.job).alias("job"),
        F.lit(labels.priority).alias("priority"),
        F.lit(labels.tower).alias("tower"),
        names.alias("client"),
        F.lit(error).alias("error"),
    )
    return clients.select(F.to_json(document).alias("document"))

"""Duplicate, null and type checks, and the split into valid and quarantined rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.functions import digests, formats, text
from reviewloom.operators import joins
from reviewloom.schemas import CRITICAL, KEY, REQUIRED

# Check names, codes and messages of the validation report.
CHECKS = ("duplicate_check", "null_check", "type_consistency_check")
CODE_PASSED = 200
CODE_BAD_DATA = 400
CODE_CONFLICT = 409
DUPLICATES_FOUND = "Registros duplicados encontrados: %d registros com base no 'id'."
DUPLICATES_NONE = "Nenhum registro duplicado encontrado."
NULLS_FOUND = "Valores nulos encontrados nas colunas: {%s}."
NULLS_NONE = "Nenhum valor nulo encontrado nas colunas criticas."
TYPES_BAD = "Valores não numericos encontrados na coluna 'im_rating'."
TYPES_GOOD = "Consistencia dos tipos de dados verificada com sucesso."

# Name of the digest column within this module.
DIGEST = "_row_digest"

DUPLICATE_REASON = "duplicate key"
NULL_REASON = "null "


def duplicate_keys(frame: DataFrame, key: str = KEY) -> DataFrame:
    """Non-null keys of more than one row, with their row count ``n``."""
    return joins.key_tally(frame, key).filter(F.col("n") > 1)


def duplicate_records(
    frame: DataFrame, key: str = KEY, repeated: DataFrame | None = None
) -> DataFrame:
    """Every copy of the rows whose key repeats. ``repeated`` are those keys, where they
    are stored already."""
    keys = duplicate_keys(frame, key) if repeated is None else repeated
    return joins.rows_with_keys(frame, keys, key, stored=repeated is not None)


def unique_rows(
    frame: DataFrame, key: str = KEY, repeated: DataFrame | None = None
) -> DataFrame:
    """Rows whose non-null key occurs once.

    Only keys are counted, or given as ``repeated`` where that is stored; the rows are then
    kept where they are, unless the repeated keys are too many to be sent to them.
    """
    keyed = frame.filter(F.col(key).isNotNull())
    keys = duplicate_keys(keyed, key) if repeated is None else repeated
    return joins.rows_with_keys(keyed, keys, key, "left_anti", stored=repeated is not None)


def is_complete(required: Sequence[str] = REQUIRED) -> Column:
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(name).isNotNull()
    return complete


def null_reasons(required: Sequence[str] = REQUIRED) -> Column:
    """Array naming the required columns that are null."""
    return F.array_compact(
        F.array(*(F.when(F.col(name).isNull(), F.lit(NULL_REASON + name)) for name in required))
    )


def reject_keys(
    frame: DataFrame,
    key: str = KEY,
    required: Sequence[str] = REQUIRED,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Rows that cannot be merged, with ``reasons``: null key, or any copy of a repeated one.

    ``finish`` is applied to those rows before their columns are looked at, for
    work that the other rows need not go through.
    """
    no_key = frame.filter(F.col(key).isNull())
    copies = duplicate_records(frame, key, repeated)
    if finish is not None:
        no_key, copies = finish(no_key), finish(copies)
    columns = list(required) if key in required else [key, *required]
    return no_key.withColumn("reasons", null_reasons(columns)).unionByName(
        copies.withColumn(
            "reasons", F.array_append(null_reasons(required), F.lit(DUPLICATE_REASON))
        )
    )


def valid_rows(
    frame: DataFrame, key: str = KEY, required: Sequence[str] = REQUIRED
) -> DataFrame:
    """Complete rows with a key of their own."""
    return unique_rows(frame, key).filter(is_complete(required))


def quarantine(
    frame: DataFrame, key: str = KEY, required: Sequence[str] = REQUIRED
) -> DataFrame:
    """The rows that are not valid, each once, with the ``reasons``."""
    incomplete = unique_rows(frame, key).filter(~is_complete(required))
    return reject_keys(frame, key, required).unionByName(
        incomplete.withColumn("reasons", null_reasons(required))
    )


def except_rows(frame: DataFrame, rejected: DataFrame) -> DataFrame:
    """Distinct rows of ``frame`` that are not in ``rejected``; nulls compare equal.

    Only digests of the rejected rows are sent to the others: rows without a partner stay
    in place. Those of a common digest are compared value by value. What is left is made
    distinct.
    """
    names = rejected.columns
    rows = frame.select(*names, digests.row_digest(frame, names).alias(DIGEST))
    marked = rejected.select("*", digests.row_digest(rejected).alias(DIGEST))
    found = session.store(marked.select(DIGEST).distinct())
    alone = joins.rows_with_keys(rows, found, DIGEST, "left_anti")
    suspected = joins.rows_with_keys(rows, found, DIGEST).distinct().alias("l")
    same = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in [DIGEST, *names]]
    different = suspected.join(marked.distinct().alias("r"), reduce(Column.__and__, same), "left_anti")
    return alone.unionByName(different).distinct().select(*names)


def null_counts(frame: DataFrame, columns: Sequence[str] = CRITICAL) -> DataFrame:
    """One row per column with its number of nulls; one pass over the frame."""
    counted = frame.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return counted.unpivot([], list(columns), "column_name", "nulls")


def bad_rating(column: str = "im_rating") -> Column:
    """True where the value is no number; null is none."""
    return text.whole_number(F.col(column)).isNull()


def quality_counts(
    frame: DataFrame,
    key: str = KEY,
    required: Sequence[str] = REQUIRED,
    critical: Sequence[str] = CRITICAL,
    rating: str = "im_rating",
    keys_unique: bool = False,
) -> DataFrame:
    """All counters of the checks as one row.

    Flags are counted per key first, so one pass and one narrow shuffle give the
    duplicate counters together with the others. Where keys are known to be
    unique, not even that shuffle is needed.
    """
    flags = {
        "n": F.lit(True),
        "complete": is_complete(required),
        "bad": bad_rating(rating),
        **{f"null_{name}": F.col(name).isNull() for name in critical},
    }
    per_key = frame.select(
        F.col(key).alias("key"),
        *(flag.cast("bigint").alias(name) for name, flag in flags.items()),
    )
    if not keys_unique:
        per_key = per_key.groupBy("key").agg(*(F.sum(name).alias(name) for name in flags))
    keyed = F.col("key").isNotNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    counted = per_key.agg(
        total(F.col("n")).alias("total_records"),
        F.count_if(keyed & (F.col("n") > 1)).alias("duplicate_keys"),
        total(F.when(keyed & (F.col("n") == 1), F.col("complete"))).alias("valid"),
        total(F.col("bad")).alias("bad_rating"),
        *(total(F.col(f"null_{name}")).alias(f"null_{name}") for name in critical),
    )
    return counted.withColumn("invalid", F.col("total_records") - F.col("valid"))


def unique_counters(
    key: str = KEY,
    required: Sequence[str] = REQUIRED,
    critical: Sequence[str] = CRITICAL,
    rating: str = "im_rating",
) -> list[Column]:
    """Aggregates for the counters of ``quality_counts`` over rows whose keys are unique,
    to be observed while the rows are written."""
    return [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col(key).isNotNull() & is_complete(required)).alias("valid"),
        F.count_if(bad_rating(rating)).alias("bad_rating"),
        *(F.count_if(F.col(name).isNull()).alias(f"null_{name}") for name in critical),
    ]


def _check(name: str, passed: Column, failed_code: int, good: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        passed.alias("status"),
        F.when(passed, CODE_PASSED).otherwise(failed_code).alias("code"),
        F.when(passed, good).otherwise(bad).alias("message"),
    )


def check_structs(critical: Sequence[str] = CRITICAL) -> list[Column]:
    """The three checks as structs over a ``quality_counts`` row."""
    found = F.array_compact(
        F.array(
            *(
                F.when(
                    F.col(f"null_{name}") > 0,
                    F.format_string(f"'{name}': %d", f"null_{name}"),
                )
                for name in critical
            )
        )
    )
    return [
        _check(
            CHECKS[0],
            F.col("duplicate_keys") == 0,
            CODE_CONFLICT,
            F.lit(DUPLICATES_NONE),
            F.format_string(DUPLICATES_FOUND, "duplicate_keys"),
        ),
        _check(
            CHECKS[1],
            F.size(found) == 0,
            CODE_BAD_DATA,
            F.lit(NULLS_NONE),
            F.format_string(NULLS_FOUND, F.array_join(found, ", ")),
        ),
        _check(
            CHECKS[2],
            F.col("bad_rating") == 0,
            CODE_BAD_DATA,
            F.lit(TYPES_GOOD),
            F.lit(TYPES_BAD),
        ),
    ]


def validation_report(counts: DataFrame, critical: Sequence[str] = CRITICAL) -> DataFrame:
    """One row per check: ``check, status, code, message`` and ``total_records``."""
    return counts.select("total_records", F.inline(F.array(*check_structs(critical)))).select(
        "check", "status", "code", "message", "total_records"
    )


def check_rollup(report: DataFrame) -> DataFrame:
    """How many checks passed and failed."""
    return report.agg(
        F.count_if("status").alias("success_count"),
        F.count_if(~F.col("status")).alias("error_count"),
    )


def segment_names(frame: DataFrame, column: str = "segmento") -> DataFrame:
    """One row, one sorted array of the distinct segments; null reads ``UNKNOWN``.

    Distinct values are found first, so only those reach the last task.
    """
    names = frame.select(F.coalesce(column, F.lit(formats.UNKNOWN)).alias("name")).distinct()
    return names.agg(F.sort_array(F.collect_list("name")).alias("names"))


def sample(frame: DataFrame, rows: int = 10, key: str = KEY) -> DataFrame:
    """The first rows in key order, for a look at the data."""
    return frame.orderBy(key).limit(rows)

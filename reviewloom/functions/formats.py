"""Formats used in metrics documents. Times are written as UTC in any session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
UNKNOWN = "UNKNOWN"
NOT_AVAILABLE = "NA"
PAIR_SEPARATOR = " => | = "
REPORT_HEADING = "Scheduling mode"
BLANKS = " \t\r\n"


def percent_of(part: Column, total: Column) -> Column:
    """Share in percent; 0.0 when there is nothing to share."""
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes with two decimals, such as ``1.25 min``."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.format_string("%.2f min", micros / 60_000_000)


def _in_utc(moment: Column) -> Column:
    here = moment.cast("timestamp").cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), here)


def to_seconds_text(moment: Column) -> Column:
    return F.date_format(_in_utc(moment), SECONDS_FORMAT)


def to_millis_text(moment: Column) -> Column:
    return F.date_format(_in_utc(moment), MILLIS_FORMAT)


def label_of(names: Column) -> Column:
    """Upper-case, comma-joined label of an array of names; ``NA`` when empty."""
    return F.when(F.size(names) > 0, F.upper(F.array_join(names, ","))).otherwise(NOT_AVAILABLE)


def report_pair(line: Column) -> Column:
    """``struct(key, value)`` of a ``key => value`` or ``key = value`` line, else null.

    Headings and lines that do not have exactly one separator give null.
    """
    blanks = F.lit(BLANKS)
    parts = F.split(F.trim(line, blanks), PAIR_SEPARATOR)
    usable = (F.size(parts) == 2) & ~line.startswith(REPORT_HEADING)
    return F.when(
        usable,
        F.struct(
            F.trim(parts[0], blanks).alias("key"),
            F.trim(parts[1], blanks).alias("value"),
        ),
    )

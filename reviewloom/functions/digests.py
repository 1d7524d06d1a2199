"""Digests of whole rows that respect nulls and nesting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, StructType


def _has_floats(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_has_floats(field.dataType) for field in kind.fields)
    if isinstance(kind, ArrayType):
        return _has_floats(kind.elementType)
    return isinstance(kind, (DoubleType, FloatType))


def _one_zero(value: Column, kind: DataType) -> Column:
    """``value`` with 0.0 for -0.0, which equals it, at any depth."""
    if not _has_floats(kind):
        return value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda e: _one_zero(e, kind.elementType))
    if isinstance(kind, StructType):
        fields = [_one_zero(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    return F.when(value == 0, F.lit(0.0).cast(kind)).otherwise(value)


def text_digest(names: Sequence[str]) -> Column:
    """16 bytes of the text columns ``names``, a null told apart from an empty text.

    Each value goes in byte by byte behind its length, so that rows of one digest are equal
    but for chance.
    """
    values = []
    for name in names:
        value = F.col(name).cast("string")
        sized = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        values.append(F.coalesce(sized, F.lit("-")))
    return F.unhex(F.md5(F.concat(*values)))


def row_digest(frame: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """16 bytes of the values of ``columns``: equal rows have equal digests.

    A null is told apart from an empty text, from a missing entry and from a null beside
    it, at any depth. Rows of one digest are equal but for chance; times that differ below
    a millisecond are not told apart.
    """
    names = frame.columns if columns is None else columns
    values = [_one_zero(F.col(name), frame.schema[name].dataType).alias(name) for name in names]
    text = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
    return F.unhex(F.md5(text))

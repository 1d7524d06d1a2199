"""A bitmap of key hashes, which tells most rows without a partner before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom import session
from reviewloom.operators import sizing

# Fixed value: bits of one bitmap as Spark's bitmap functions make them.
BITS = 32_768

# Bits per key. Of the keys that are not in the map, one in this many passes.
SPREAD = 8

# Bytes of a broadcast row of the map.
ROW = BITS // 8 + 64


def maps_for(keys: int, limit: int = sizing.BROADCAST_LIMIT) -> int:
    """How many bitmaps hold ``keys`` at ``SPREAD`` bits each, 0 if they pass ``limit`` bytes."""
    maps = max(1, -(-keys * SPREAD // BITS))
    return maps if maps * ROW <= limit else 0


def _place(key: str, maps: int) -> Column:
    """A key's bit, from 1, as Spark's bitmap functions count."""
    return F.pmod(F.xxhash64(key), F.lit(maps * BITS)) + 1


def bitmap_of(keys: DataFrame, key: str, maps: int) -> DataFrame:
    """``maps`` rows at most: ``bucket`` and ``bitmap``, a bit set for every hash of ``key``."""
    place = _place(key, maps)
    return (
        keys.filter(F.col(key).isNotNull())
        .groupBy(F.bitmap_bucket_number(place).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    )


def _bit(bitmap: Column, position: Column) -> Column:
    byte = F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.getbit(value, (position % 8).cast("int")) == 1


def likely_rows(
    frame: DataFrame, keys: DataFrame, key: str, limit: int = sizing.BROADCAST_LIMIT
) -> DataFrame:
    """Rows of ``frame`` whose key is in ``keys``, and few others; nothing is shuffled but
    the bitmap, which is broadcast.

    Where even a bitmap of the keys is larger than ``limit``, all rows are returned: what
    follows must match the keys anyway.
    """
    maps = maps_for(keys.count(), limit)
    if not maps:
        return frame
    bits = F.broadcast(session.store(bitmap_of(keys, key, maps)))
    place = _place(key, maps)
    columns = [F.col(name) for name in frame.columns]
    return (
        frame.filter(F.col(key).isNotNull())
        .select(*columns, F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("_bit"))
        .join(bits, "bucket")
        .filter(_bit(F.col("bitmap"), F.col("_bit")))
        .select(*columns)
    )

"""A Bloom filter as a table of bitmaps, to leave rows out before they are shuffled."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from content_signals.plans.staging import stage

#: Bits of one bitmap; a fixed value of Spark's bitmap functions.
_BITS = 1 << 15
_BITS_PER_KEY = 16
#: Bound of what is broadcast: 4096 bitmaps of 4 KB. Beyond 8 million keys more rows pass, none is lost.
MAX_BITMAPS = 1 << 12
_SEEDS = (1, 2)


def _bitmap(key: Column, bitmaps: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(bitmaps))


def _places(key: Column) -> list[Column]:
    """A key's bits, which lie in one bitmap."""
    return [F.pmod(F.xxhash64(F.lit(seed), key), F.lit(_BITS)) for seed in _SEEDS]


def bloom_table(members: DataFrame, key: str) -> tuple[DataFrame, int]:
    """``(_bitmap, _bits)`` over the values of a column, and the number of bitmaps.

    Its size follows from the number of rows, up to ``MAX_BITMAPS`` bitmaps. Bits are set by an
    aggregation, which Spark begins before it shuffles.
    """
    n = members.count()
    bitmaps = min(MAX_BITMAPS, 1 << max(0, math.ceil(math.log2(max(1, n) * _BITS_PER_KEY / _BITS))))
    bits = members.filter(F.col(key).isNotNull()).select(
        _bitmap(F.col(key), bitmaps).alias("_bitmap"), F.explode(F.array(*_places(F.col(key)))).alias("_place")
    )
    table = bits.groupBy("_bitmap").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    return stage(table, "bloom"), bitmaps


def may_be_member(rows: DataFrame, key: str, members: DataFrame, member_key: str | None = None) -> DataFrame:
    """The rows whose key may be among the members' keys: all that are, and few others.

    The filter is broadcast, so nothing is shuffled and the members may be any number.
    """
    table, bitmaps = bloom_table(members, member_key or key)
    tested = rows.withColumn("_bitmap", _bitmap(F.col(key), bitmaps)).join(F.broadcast(table), "_bitmap")
    all_set = F.lit(True)
    for place in _places(F.col(key)):
        byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        all_set = all_set & (F.bit_get(byte.cast("long"), (place % 8).cast("int")) == 1)
    return tested.filter(all_set).select(*rows.columns)

"""A one-hash Bloom filter as rows of bitmaps, built and tested by built-in functions.

A filter of a small side is broadcast to drop most rows of a large side before they are
shuffled: at most ``MOST_BITS`` bits (8 MB) whatever the side's size, and exact rows are
never lost (what passes by chance the join behind it drops).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a key, and of a filter at most.
BITS_A_KEY, MOST_BITS = 16, 1 << 26


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def bloom(keys: DataFrame, key: str, n: int) -> tuple[DataFrame, int]:
    """(bitmap number, bitmap) of the filter of ``keys``, about ``n`` of them, and its number of bits."""
    bits = min(MOST_BITS, max(1 << 15, n * BITS_A_KEY))
    at = keys.select(_bit(F.col(key), bits).alias("at"))
    maps = at.groupBy(F.bitmap_bucket_number("at").alias("map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bitmap"))
    return maps, bits


def might_be_in(df: DataFrame, key: str, maps: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose key may be one of the filter's (bounded: the filter is broadcast)."""
    at = _bit(F.col(key), bits)
    sides = df.withColumn("_map", F.bitmap_bucket_number(at)).join(F.broadcast(maps), F.col("_map") == F.col("map"))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("bitmap", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return sides.where(F.getbit(byte, (place % 8).cast("int")) == 1).select(*df.columns)

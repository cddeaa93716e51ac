"""A set of keys small enough to broadcast, so that wide rows need not be shuffled to be compared with it.

The set is a bitmap over the keys' hashes: at most ``POSITIONS`` bits, 16 MB, whatever its size. A key in the set
is always found; one that is not may be found too, so an exact step has to follow wherever that matters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a set; of n keys that are not in a set of m, about n * m / POSITIONS are found all the same.
POSITIONS = 1 << 27


def _position(columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(POSITIONS))


def key_set(keys: DataFrame) -> DataFrame:
    """The keys, one a row of all columns, as bitmaps: one row for each bucket of positions that has any."""
    positions = keys.select(_position(keys.columns).alias("_position"))
    return positions.groupBy(F.bitmap_bucket_number("_position").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_position")).alias("_bitmap")
    )


def with_membership(df: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """Add the boolean ``name``: true for every row whose key, named as in ``keys``, is among them, and for a few
    others. ``keys`` is worked out apart from ``df``, whose rows stay where they are."""
    position = _position(keys.columns)
    bit = F.bitmap_bit_position(position)
    byte = F.conv(F.hex(F.substr("_bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    placed = df.withColumn("_bucket", F.bitmap_bucket_number(position))
    return placed.join(F.broadcast(key_set(keys)), "_bucket", "left").withColumn(name, found).drop("_bucket", "_bitmap")

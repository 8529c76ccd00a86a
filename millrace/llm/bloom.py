"""A Bloom filter sized by its keys, built by Spark and carried to tasks.

It only spares work: what passes is joined exactly afterwards. It has 2 MB at least and 16 MB at
most. With 10 bits for a key it lets less than 2 % of other keys through, with 32 less than
0.1 %; more keys than it has bits for go in parts, or by a join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the smallest and the largest filter.
LEAST_BITS, MOST_BITS = 1 << 24, 1 << 27
_HASHES = 3


def bits_for(keys: int, each: int = 10) -> int:
    """A power of two with so many bits for a key, within the limits."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (each * max(keys, 1) - 1).bit_length()))


def bloom_of(frame: DataFrame, key: Column, keys: int, each: int = 10) -> bytes:
    """The filter of a column of longs whose bits are already well mixed.

    ``keys`` is how many it has, about. At most 4,096 rows of 4 kB come to the driver.
    """
    bits = bits_for(keys, each)
    first, step = F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("key", 32).bitwiseOR(F.lit(1))
    places = [(first + step * k).bitwiseAND(F.lit(bits - 1)) for k in range(_HASHES)]
    # positions are counted from 1, where Spark's buckets of 32768 begin
    found = (
        frame.select(key.alias("key"))
        .select(F.explode(F.array(*[p + 1 for p in places])).alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    )
    size = 32768 // 8
    body = bytearray(bits // 8)
    for row in found.collect():
        at = (row.bucket - 1) * size
        body[at : at + size] = row.bits
    return bytes(body)


def passes(body: bytes, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit keys may be in the filter."""
    bits = np.frombuffer(body, np.uint8)
    mask = np.uint64(8 * len(bits) - 1)
    first, step = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    found = np.ones(len(keys), bool)
    for k in range(_HASHES):
        place = (first + step * np.uint64(k)) & mask
        found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found

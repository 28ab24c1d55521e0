"""A table of bits for 64-bit hashes, merged by Spark: which hashes may be in a set. Its size is fixed, so it may go everywhere.

Hashes that share a place by chance are taken for members, which costs work and never results.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PLACES_BITS = 27
#: Bits of one of Spark's bitmaps.
BITMAP = 1 << 15


def table_of(hashes: DataFrame, column: str) -> Broadcast:
    number = F.shiftrightunsigned(column, 64 - PLACES_BITS) + 1
    merged = hashes.select(F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
    bits = np.zeros(((1 << PLACES_BITS) // BITMAP, BITMAP // 8), np.uint8)
    for row in merged.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        bits[row["bucket"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits.reshape(-1))


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes >> np.uint64(64 - PLACES_BITS)).astype(np.int64)
    return ((bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1).astype(bool)

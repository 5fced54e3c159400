"""A fixed-size bitmap of hashes, to keep what has no partner out of a shuffle.

A hash that is in the set is always found; one that is not, seldom.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26


def bitmap(found: DataFrame) -> bytes:
    """One bit per value of the seeds' low ``BITS`` bits: 8 MB at most."""
    low = F.col("seed").bitwiseAND((1 << BITS) - 1)
    rows = (found.groupBy(F.bitmap_bucket_number(low).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(low)).alias("bits")).collect())
    size = 1 << 12
    out = bytearray((1 << BITS) // 8 + 2 * size)
    for r in rows:
        out[r["bucket"] * size:(r["bucket"] + 1) * size] = r["bits"]
    return bytes(out)


def known(bits: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Whether the bitmap has each seed's low bits."""
    low = (s & np.uint64((1 << BITS) - 1)).astype(np.int64)
    # value v > 0 is position (v - 1) of the buckets that count from 1; 0 is bit 0 of bucket 0
    at = np.where(low > 0, low - 1 + (1 << 15), 0)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

"""A Bloom filter of bounded size that tasks use to leave rows out early.

It never replaces a join: rows that pass are joined exactly afterwards, so a filter
that is too small for its keys costs time only.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A filter has at most so many bits (16 MiB).
MAX_LOG2 = 27
BITS_PER_KEY = 16


def build(hashes: DataFrame, column: str = "h", max_log2: int = MAX_LOG2) -> np.ndarray:
    """Filter of the 64-bit hashes in ``column``: two bits per key, set in Spark by
    words of 64 bits; at most ``2 ** max_log2`` bits reach the driver."""
    keys = hashes.count()
    log2 = min(max_log2, max(16, math.ceil(math.log2(BITS_PER_KEY * max(keys, 1)))))
    mask = (1 << log2) - 1
    h = F.col(column)
    at = F.explode(F.array(h.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(mask)))).alias("at")
    one = F.expr("shiftleft(1L, cast(at & 63 as int))")
    rows = (hashes.select(at).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(one).alias("bits"))).toArrow()
    words = np.zeros(1 << (log2 - 6), dtype=np.uint64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return words


def test(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each 64-bit hash may be a key."""
    mask = np.uint64(64 * len(words) - 1)
    h = h.view(np.uint64)
    hit = np.ones(len(h), dtype=bool)
    for at in (h & mask, (h >> np.uint64(32)) & mask):
        hit &= ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
    return hit

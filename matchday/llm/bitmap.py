"""A bitmap of hashes whose size is bounded, whatever the number of hashes.

It only ever spares work: a hash that is in the table always passes, others pass by chance, and an exact join follows.
At most ``2**MAX_BITS`` bits (16 MiB) reach the driver and the executors; beyond that many hashes more of the others
pass, and results stay the same.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 27


class Bitmap:
    def __init__(self, words: np.ndarray):
        self._words = words
        self._mask = np.uint64(len(words) * 64 - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes.view(np.uint64) & self._mask
        return (self._words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def bits_for(n: int) -> int:
    """About 16 bits for each of ``n`` hashes, from 2**16 to 2**MAX_BITS."""
    return min(MAX_BITS, max(16, math.ceil(math.log2(16 * max(n, 1)))))


def bitmap(hashes: DataFrame, column: str, n: int) -> Broadcast:
    """Broadcast bitmap of a column of well mixed 64-bit hashes; ``n``: how many there are, about."""
    bits = bits_for(n)
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        hashes.where(F.col(column).isNotNull())
        .select(F.shiftright(low, 6).alias("word"), low.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(Bitmap(words))

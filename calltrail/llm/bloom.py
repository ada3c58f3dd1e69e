"""A Bloom filter of 64-bit keys with a fixed size bound, built on the executors slice by slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICES = 256
HASHES = 4
#: Keys that a broadcast filter is built for; 16 bits a key, so 32 MB at most.
CAPACITY = 1 << 24
_GOLD, _A = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _spots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Slice of each key, and its bits there. bits: a power of two."""
    k = keys.view(np.uint64)
    h = (k ^ (k >> np.uint64(32))) * _GOLD
    h ^= h >> np.uint64(29)
    g = (h * _A) | np.uint64(1)
    mask = np.uint64(bits - 1)
    return (k & np.uint64(SLICES - 1)).astype(np.int64), [(((h + np.uint64(i) * g) >> np.uint64(20)) & mask).astype(np.int64) for i in range(HASHES)]


class Bloom:
    def __init__(self, words: np.ndarray):
        self.words = words  # SLICES rows of bytes

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that are not in it."""
        at, spots = _spots(keys, self.words.shape[1] * 8)
        out = np.ones(len(keys), bool)
        for s in spots:
            out &= (self.words[at, s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1
        return out


def build(keys: DataFrame, column: str, n: int) -> Bloom | None:
    """The filter of n keys (a long column), or None where there are more than CAPACITY.

    A slice's keys meet in one task: 1/256 of what is at most CAPACITY keys.
    """
    if n > CAPACITY:
        return None
    bits = 1 << max(6, int(np.ceil(np.log2(max(1, 16 * n / SLICES)))))

    def slice_of(part: pa.Table) -> pa.Table:
        own = part.column(0).to_numpy()
        words = np.zeros(bits, np.uint8)
        _, spots = _spots(own, bits)
        for s in spots:
            words[s] = 1
        return pa.table({"slice": pa.array([int(own[0]) & (SLICES - 1)], pa.int64()), "words": pa.array([np.packbits(words, bitorder="little").tobytes()], pa.binary())})

    rows = keys.select(F.col(column).alias("key")).groupBy(F.col("key").bitwiseAND(F.lit(SLICES - 1)).alias("s")).applyInArrow(slice_of, "slice long, words binary").collect()
    words = np.zeros((SLICES, bits // 8), np.uint8)
    for r in rows:
        words[r["slice"]] = np.frombuffer(r["words"], np.uint8)
    return Bloom(words)

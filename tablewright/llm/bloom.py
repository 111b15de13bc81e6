"""Once-seen and twice-seen Bloom filters over 64-bit hashes, built by the tasks and merged.

Both filters of two tasks merge without looking at the data again: what either has seen once is
in the union of the once filters; what was seen twice is in a twice filter or in both once
filters. The union and the intersection of bit arrays can add false positives, never remove an
entry, so whoever only treats hits as suspicions stays exact at any fill.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROBES = 3
SEGMENT = 1 << 16  # bytes of a filter that travel and merge together


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``PROBES`` bit positions for each hash, one row a probe; ``bits`` is a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)]).astype(np.int64)


def put(bitmap: np.ndarray, hashes: np.ndarray) -> None:
    p = positions(hashes, len(bitmap) * 8).ravel()
    np.bitwise_or.at(bitmap, p >> 3, (1 << (p & 7)).astype(np.uint8))


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    p = positions(hashes, len(bitmap) * 8)
    return ((bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1).all(axis=0)


class Seen:
    """The two filters of one task."""

    def __init__(self, bits: int):
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        unique, counts = np.unique(hashes, return_counts=True)
        put(self.twice, unique[(counts > 1) | holds(self.once, unique)])
        put(self.once, unique)

    def record(self, task: int) -> pa.RecordBatch:
        """The filters of the task ``task`` cut into segments; empty segments are left out."""
        n = min(SEGMENT, len(self.once))
        found = [
            (i, task, zlib.compress(o.tobytes(), 1), zlib.compress(t.tobytes(), 1))
            for i, (o, t) in enumerate(zip(self.once.reshape(-1, n), self.twice.reshape(-1, n), strict=True))
            if o.any()
        ]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["segment", "task", "once", "twice"])


ROWS = "segment int, task int, once binary, twice binary"


def merge(rows: DataFrame, bits: int, fan_in: int = 128, levels: int = 3) -> np.ndarray:
    """The twice filter of all tasks. The driver gets ``bits`` / 8 bytes at most.

    Each segment merges level by level, so that no group holds more than ``fan_in`` rows with up
    to ``fan_in ** levels`` tasks (two million).
    """

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        once = twice = np.uint8(0)
        for o, t in zip(pdf["once"], pdf["twice"], strict=True):
            o, t = np.frombuffer(zlib.decompress(o), np.uint8), np.frombuffer(zlib.decompress(t), np.uint8)
            once, twice = once | o, twice | t | (once & o)
        return pd.DataFrame([(pdf["segment"].iloc[0], pdf["task"].iloc[0] // fan_in, zlib.compress(once.tobytes(), 1), zlib.compress(twice.tobytes(), 1))], columns=["segment", "task", "once", "twice"])

    level = rows
    for _ in range(levels - 1):
        level = level.groupBy("segment", F.expr(f"task div {fan_in}").alias("part")).applyInPandas(joined, ROWS)
    level = level.groupBy("segment").applyInPandas(joined, ROWS)
    out, n = np.zeros(bits // 8, np.uint8), min(SEGMENT, bits // 8)
    for row in level.select("segment", "twice").toLocalIterator():
        out[row.segment * n : (row.segment + 1) * n] = np.frombuffer(zlib.decompress(bytes(row.twice)), np.uint8)
    return out


def bits_for(entries: int, per_entry: int = 12, most: int = 1 << 30) -> int:
    """A power of two of bits: ``per_entry`` for each entry, 2**20 at least, ``most`` at most."""
    return min(most, max(1 << 20, 1 << (max(1, entries * per_entry) - 1).bit_length()))

"""Words of whole texts as arrays of byte positions and 64-bit hashes, for use inside tasks.

Texts arrive as Arrow batches. ``pieces`` cuts a batch into runs of whole rows of about ``PIECE`` bytes, so that the
arrays below stay small however many rows a batch has; a single longer text is a piece by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

PIECE = 1 << 18
ALL = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + np.uint64(seed * 0x632BE59BD9B4E019 & ALL))


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Word bytes of the two word patterns; every byte of a character beyond ASCII is a word byte in both.
NOT_BLANK = ~byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

CODES = numbers(1, 256)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    return _powers(base, 1 << max(PIECE.bit_length(), n.bit_length()))[:n]


@dataclass
class Words:
    """Words of the rows of a piece: row ``i`` has the words ``bounds[i]`` to ``bounds[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(CODES[self.data] * powers(BASE, len(self.data)), out=sums[1:])
        shifted = (sums[self.ends] - sums[self.starts]) * powers(INVERSE, len(self.data) + 1)[self.starts]
        return mixed(shifted)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def words_of(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> Words:
    """Maximal runs of word bytes that do not cross from one row into the next."""
    inside = word_bytes[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[filled] = inside[filled]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = inside[ends]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and where each begins; a null is empty."""
    column = column.cast(pa.large_string())
    _, begins, data = column.buffers()
    offsets = np.frombuffer(begins, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), offsets


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets within the bytes) of each piece."""
    data, offsets = utf8(column)
    low, n = 0, len(column)
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PIECE, "right")) - 1)
        high = min(high, n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


class Places:
    """Where hashes are remembered, in the order they came; a few bytes each, where a dict takes a hundred."""

    def __init__(self, size: int):
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where it is new."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        found = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[found] == hashes, self.at[found], -1).astype(np.int64)

    def add(self, hashes: np.ndarray) -> None:
        """Remember new, distinct hashes in ascending order at the next places."""
        before = np.searchsorted(self.keys, hashes)
        at = np.arange(len(self.keys), len(self.keys) + len(hashes), dtype=np.int32)
        self.keys, self.at = np.insert(self.keys, before, hashes), np.insert(self.at, before, at)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to tasks in batches of so many rows, unless the session has a number of its own.

    Spark's default of 10,000 rows holds tens of MB of text per task twice, in the executor and in its worker.
    """
    if int(spark.conf.get(BATCH)) == 10_000:
        spark.conf.set(BATCH, str(rows))


def long_array(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def binary_array(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, type=pa.binary())


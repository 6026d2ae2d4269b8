"""Hashes of words and of runs of words, for whole Arrow batches.

Words are what ``bytes.split()`` gives: runs without the six ASCII white-space
characters.  A word's hash is a polynomial of its bytes modulo 2**64, mixed;
a run's hash a polynomial of its words' hashes, mixed.  Everything is
computed with array operations on ``CHUNK_BYTES`` of text at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text that is hashed at once; a longer document is taken by itself.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose bits all depend on each other."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base, and of its inverse, modulo 2**64."""

    def __init__(self, base: int):
        self._base = base
        self._table = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self._table) < n:
            size = 1 << max(10, (n - 1).bit_length())
            table = np.full(size, np.uint64(self._base))
            table[0] = 1
            self._table = np.multiply.accumulate(table)
        return self._table[:n]


_INVERSE = pow(int(_BASE), -1, 1 << 64)
_UP, _DOWN = _Powers(int(_BASE)), _Powers(_INVERSE)


def _hash_words(data: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of words before each document."""
    space = _SPACE[data]
    filled = limits[:-1][limits[:-1] < limits[1:]]
    before = np.empty(len(data), dtype=bool)
    before[1:] = space[:-1]
    before[filled] = True
    starts = np.flatnonzero(~space & before)
    first = np.searchsorted(starts, limits)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), first
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data)) - np.concatenate(
        [np.zeros(starts[0], dtype=np.int64), np.repeat(starts, lengths)])
    value = (data.astype(np.uint64) + np.uint64(1)) * _UP.upto(int(place.max()) + 1)[place]
    value[space] = 0
    return mixed(np.add.reduceat(value, starts)), first


def hashed(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, hashes of its words)`` for every text, in order."""
    if texts.null_count:
        texts = texts.fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    limits = np.frombuffer(texts.buffers()[1], dtype=width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(limits, limits[row] + CHUNK_BYTES, side="right")) - 1)
        end = min(end, len(texts))
        hashes, first = _hash_words(data[limits[row]:limits[end]], limits[row:end + 1] - limits[row])
        for i in range(row, end):
            yield i, hashes[first[i - row]:first[i - row + 1]]
        row = end


class Runs:
    """Hashes of the runs of one document's words."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n = n
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(words * _UP.upto(n + 1)[:n], out=self._sums[1:])
        self._back = _DOWN.upto(n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._back[starts] + (ends - starts).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of every run of ``length`` words."""
        starts = np.arange(max(0, self.n - length + 1))
        return self.of(starts, starts + length)

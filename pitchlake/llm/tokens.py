"""Words of whole Arrow string columns as numpy arrays: bounds, documents and 64-bit hashes.

A word hash is a polynomial in the word's bytes modulo 2^64, then mixed. All words of a block are
hashed at once from one prefix sum, without a Python object per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 19

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)
#: Separators of ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[:128] = True
NOT_ALNUM[48:58] = False
NOT_ALNUM[97:123] = False


@dataclass
class Words:
    """Words of a column in row order; ``first[d]`` is the index of row d's first word."""

    bytes: np.ndarray  # mapped bytes of the whole column
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one entry per row and one more
    offsets: np.ndarray  # byte bounds of the rows

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a uint64 array."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base), dtype=np.uint64)
    out[0] = U(1)
    return np.multiply.accumulate(out)


def column_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a string column; a NULL is an empty row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(column: pa.Array, separators: np.ndarray = SPACES, mapped: np.ndarray = SAME) -> Words:
    """Find the words of every row. ``mapped`` replaces bytes first (``LOWER``: A-Z to a-z)."""
    data, offsets = column_bytes(column)
    data = mapped[data] if mapped is not SAME else data
    n = len(data)
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(separators[data], out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begins[cut] = inside[1:-1][cut]
    ends[cut - 1] = inside[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), offsets)


def hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word."""
    n = len(words.start)
    out = np.empty(n, np.uint64)
    at, up, down = 0, _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)
    while at < n:
        origin = words.start[at]
        to = max(int(np.searchsorted(words.end, origin + _BLOCK, "right")), at + 1)
        size = int(words.end[to - 1] - origin)
        if size > len(up):
            up, down = _powers(_BASE, size), _powers(_INVERSE, size)
        sums = np.zeros(size + 1, np.uint64)
        terms = words.bytes[origin : origin + size].astype(np.uint64)
        terms += U(1)
        terms *= up[:size]
        np.cumsum(terms, out=sums[1:])
        s, e = words.start[at:to] - origin, words.end[at:to] - origin
        out[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return mix(out)


def hash_of(word: bytes) -> int:
    """The hash of one word, as ``hashes`` gives it."""
    return int(hashes(split(pa.array([word], pa.binary()), np.zeros(256, bool)))[0])


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive entries of ``h``, from one rolling sum per block."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    up, down = _powers(_BASE, _BLOCK + size), _powers(_INVERSE, _BLOCK)
    for at in range(0, n, _BLOCK):
        m = min(_BLOCK, n - at)
        sums = np.zeros(m + size, np.uint64)
        np.cumsum(h[at : at + m + size - 1] * up[: m + size - 1], out=sums[1:])
        out[at : at + m] = (sums[size:] - sums[:m]) * down[:m]
    return mix(out)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Indexes of the words at which a window of ``size`` words of one row starts."""
    n = int(first[-1])
    ok = np.zeros(n + 1, np.int32)
    counts = np.diff(first)
    long = counts >= size
    np.add.at(ok, first[:-1][long], 1)
    np.add.at(ok, first[1:][long] - size + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)


def pieces(batches, limit: int = 24_000_000):
    """Record batches cut so that each holds about ``limit`` bytes at most, one row at least."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            rows = batch.num_rows - at
            while rows > 1 and batch.slice(at, rows).nbytes > limit:
                rows = (rows + 1) // 2
            yield batch.slice(at, rows)
            at += rows

"""Words of Arrow text columns as 64-bit hashes, a chunk of whole documents at a time, in numpy.

A word is a run of bytes that are no separators. Its hash is a polynomial of its bytes modulo 2^64 with a
finalizer, taken from prefix sums, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_P = 0x9E3779B97F4A7C15
_PI = pow(_P, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: By byte: is it white space (\x20, \x09-\x0D)?
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: By byte: is it no letter (ASCII letters and all bytes of other scripts count as letters)?
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_P, _PI)):
            x = np.full(1 << max(16, (n - 1).bit_length()), base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


class Words(NamedTuple):
    """Words of documents first..last-1 of a batch; document i has words at[i-first]..at[i-first+1]-1."""

    first: int
    last: int
    hash: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray
    sums: np.ndarray

    def prefixes(self, n: int, some: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the first n bytes of (some) words of n bytes or more, and which of these those are."""
        start = self.start[some]
        long = np.flatnonzero(self.end[some] - start >= n)
        a = start[long]
        return mix((self.sums[a + n] - self.sums[a]) * powers(len(self.data) + 1)[1][a] + np.uint64(0x51ED270B + n)), long


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    return np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8), offsets


def ranges(offsets: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of documents of up to limit bytes in all, one document at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offsets: np.ndarray, i: int, j: int, separator=SPACE, lower: bool = False) -> Words:
    """Hash the words of documents i..j-1."""
    lo, hi = int(offsets[i]), int(offsets[j])
    part = data[lo:hi]
    if lower:
        part = LOWER[part]
    n, edges = hi - lo, offsets[i : j + 1] - lo
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separator[part]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = edges[1:-1][(edges[1:-1] > 0) & (edges[1:-1] < n)]  # words end where documents do
    begins[cut] = inside[1:-1][cut]
    ends[cut - 1] = inside[1:-1][cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    value = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return Words(i, j, value, np.searchsorted(start, edges), start, end, part, sums)


def each_chunk(column: pa.Array, separator=SPACE, lower: bool = False, limit: int = CHUNK) -> Iterator[Words]:
    """Words of a text column, a chunk of whole documents at a time."""
    data, offsets = text_bytes(column)
    for i, j in ranges(offsets, limit):
        yield words(data, offsets, i, j, separator, lower)


def grams(hashes: np.ndarray, n: int, seed: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """Hashes of n consecutive items, at each of len - n + 1 places (empty when there are fewer)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out *= np.uint64(seed)
        out += hashes[k : k + m]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive items, from running minima of blocks of w."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)
    rows = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def distinct(x: np.ndarray) -> np.ndarray:
    """The different values in order, by sorting, which is faster here than the hash table of np.unique."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    return x[new]


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)

"""Vectorised text helpers: blocks of whole texts, words, polynomial hashes and winnowing over numpy arrays.

All hashes are sums of T[x_i] * B**i modulo 2**64 (T random per byte, B odd), so that the hash of any
slice is a difference of two prefix sums times an inverse power; results are mixed before use.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK_BYTES = 1 << 18  #: small enough that the arrays of a block stay in the cache
SPACES = b" \t\n\x0b\x0c\r"
_rng = np.random.default_rng(20240917)
BYTE_TABLES = _rng.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) * U64(2) + U64(1)
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


NOT_SPACE = ~byte_class(SPACES)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of an Arrow string array as (first row, end row, bytes, offsets); a null is an empty text.

    A piece holds whole texts of about ``limit`` bytes, or one longer text.
    """
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=n + 1 + texts.offset)[texts.offset:]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(31))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h = h * U64(0x94D049BB133111EB)
    h ^= h >> U64(32)
    return h


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(size, dtype=np.uint64)
        done = 1
        while done < size:
            step = min(done, size - done)
            p[done:done + step] = p[:step] * U64(pow(b, done, 1 << 64))
            done += step
        out.append(p)
    return out[0], out[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers and inverse powers of an odd base, at least ``size`` of each."""
    room = 1 << max(16, int(size - 1).bit_length())
    return _powers(base, room)


class Sums:
    """Prefix sums of a sequence of 64-bit codes, for hashes of slices."""

    def __init__(self, codes: np.ndarray, which: int = 0):
        n = len(codes)
        up, self.down = powers(BASES[which], n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * up[:n], out=self.sums[1:])

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all slices of length k, by start."""
        return mix(self.raw_grams(k) + U64(k))

    def raw_grams(self, k: int) -> np.ndarray:
        """The same without mixing: the leading bits are good enough to choose by."""
        m = len(self.sums) - k
        return (self.sums[k:] - self.sums[:m]) * self.down[:m] if m > 0 else np.zeros(0, np.uint64)


def word_spans(buf: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the index of its first word (one more entry closes the last)."""
    inside = word_bytes[buf]
    n = len(buf)
    edge = np.empty(n + 1, dtype=bool)
    if n:
        edge[0], edge[n] = inside[0], False
        edge[1:n] = inside[1:] & ~inside[:-1]
        cuts = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < n)]
        edge[cuts] = inside[cuts]
        starts = np.flatnonzero(edge[:n])
        stop = np.empty(n + 1, dtype=bool)
        stop[0], stop[n] = False, inside[n - 1]
        stop[1:n] = inside[:-1] & ~inside[1:]
        stop[cuts] = inside[cuts - 1]
        ends = np.flatnonzero(stop)
    else:
        starts = ends = np.zeros(0, dtype=np.int64)
    return starts, ends, np.searchsorted(starts, offsets)


def word_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit codes of words."""
    return Sums(BYTE_TABLES[which][buf], which).slices(starts, ends)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    m, size = x, 1
    while size * 2 <= w:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = w - size
    return np.minimum(m[:-rest], m[rest:]) if rest else m


PLACE_BITS = 24
SEGMENT = 1 << 22


def winnow(grams: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that choose the same gram: (gram position, first window, last window).

    A window is w consecutive grams and chooses the leftmost of those whose hashes, without their low bits, are smallest.
    That depends on its contents alone: equal windows choose the same gram at the same place.
    """
    if len(grams) < w:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty
    low = U64((1 << PLACE_BITS) - 1)
    at = np.empty(len(grams) - w + 1, dtype=np.int64)
    for s in range(0, len(at), SEGMENT):
        piece = grams[s:s + SEGMENT + w - 1]
        at[s:s + SEGMENT] = (sliding_min((piece & ~low) | np.arange(len(piece), dtype=np.uint64), w) & low).astype(np.int64) + s
    change = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate(([0], change))
    last = np.concatenate((change - 1, [len(at) - 1]))
    return at[first], first, last

"""Whole Arrow batches of texts as flat numpy arrays: bytes, words and their hashes.

Word boundaries that are ASCII can be found on UTF-8 bytes, since no byte of a longer character is
below 0x80. A batch is handled as one byte string with document borders, so there is no Python
loop over words, and very long documents take memory in proportion to their length only.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x100000001B3 | 0x9E3779B900000001

SPACES = np.zeros(256, bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit scramble (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        z = values + _GOLDEN * np.uint64(salt + 1)
        z = (z ^ (z >> np.uint64(30))) * _MIX_1
        z = (z ^ (z >> np.uint64(27))) * _MIX_2
        return z ^ (z >> np.uint64(31))


def _powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base & (2**64 - 1), np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers, and their inverses modulo 2**64: the base is odd."""
    return _slice_tables() if n <= 1 << 20 else _tables(n)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(n), _powers(n, pow(_BASE, -1, 1 << 64))


@cache
def _slice_tables() -> tuple[np.ndarray, np.ndarray]:
    return _tables(1 << 20)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offset of every row; a null is an empty row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


class Words:
    """The words of a batch: `start` and `end` in `raw`, `doc` (row of the batch), `first` (index of
    each row's first word, with the total at the end)."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, separator: np.ndarray = SPACES):
        self.raw, self.bounds = raw, bounds
        inside = ~separator[raw]
        before = np.empty_like(inside)
        if len(raw):
            before[0] = False
            before[1:] = inside[:-1]
            heads = bounds[:-1][bounds[:-1] < len(raw)]
            before[heads] = False  # a word ends with its document
        self.start = np.flatnonzero(inside & ~before)
        ends_here = inside.copy()
        if len(raw):
            follows = np.empty_like(inside)
            follows[-1] = False
            follows[:-1] = inside[1:] & before[1:]
            ends_here &= ~follows
        self.end = np.flatnonzero(ends_here) + 1
        self.first = np.searchsorted(self.start, bounds)
        self.doc = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        if not len(self):
            return np.zeros(0, np.uint64)
        size = self.end - self.start
        low = int(self.start[0])
        span = int(self.end[-1]) - low
        powers, inverse = _power_tables(span)
        with np.errstate(over="ignore"):
            # sums of letters times the powers of their places, of which a word is a difference
            letters = self.raw[low : low + span].astype(np.uint64)
            letters += np.uint64(1)
            letters *= powers[:span]
            sums = np.empty(span + 1, np.uint64)
            sums[0] = 0
            np.cumsum(letters, out=sums[1:])
            total = (sums[self.end - low] - sums[self.start - low]) * inverse[self.start - low]
        return mix(total ^ (size.astype(np.uint64) << np.uint64(48)))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent hashes of the `n` consecutive values at each place; the last n-1 are void."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            out *= np.uint64(_BASE & (2**64 - 1))
            out += hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def same_row(doc: np.ndarray, n: int) -> np.ndarray:
    """Of the places `grams` covers, those whose values all belong to one row."""
    if len(doc) < n:
        return np.zeros(0, bool)
    return doc[: len(doc) - n + 1] == doc[n - 1 :]


_PLACE_BITS = np.uint64(24)
_CHUNK = 1 << 18


def byte_hashes(raw: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes that begin at each place (0 <= place <= len - k), by doubling."""
    n = len(raw) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if n > 2 * _CHUNK:  # in pieces that fit a cache
        cuts = range(0, n, _CHUNK)
        return np.concatenate([byte_hashes(raw[c : min(n, c + _CHUNK) + k - 1], k) for c in cuts])
    power = raw.astype(np.uint64) + np.uint64(1)  # hashes of `width` bytes
    width, factor, done, out = 1, _BASE & (2**64 - 1), 0, np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        while True:
            if k & width:
                out = out * np.uint64(factor) + power[done : done + n]
                done += width
            if 2 * width > k:
                return mix(out)
            power = power[:-width] * np.uint64(factor) + power[width:]
            width, factor = 2 * width, factor * factor % 2**64


def anchors(values: np.ndarray, w: int) -> np.ndarray:
    """For each window of `w` hashes the place of its least one, the leftmost of equal ones.

    Hashes are compared by their upper 40 bits. Only what is inside the window decides, so equal
    windows have equal anchors wherever they stand.
    """
    n = len(values) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    # in pieces that fit a cache; the place in the piece breaks ties towards the left
    for at in range(0, n, _CHUNK):
        piece = values[at : min(n, at + _CHUNK) + w - 1]
        level = (piece >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(piece), dtype=np.uint64)
        count, width = len(piece) - w + 1, 1
        while 2 * width <= w:
            level = np.minimum(level[:-width], level[width:])
            width *= 2
        least = np.minimum(level[:count], level[w - width : w - width + count])
        out[at : at + count] = (least & np.uint64((1 << 24) - 1)).astype(np.int64) + at
    return out

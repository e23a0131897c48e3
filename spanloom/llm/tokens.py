"""Words, windows and anchors of a batch of texts, on whole arrays instead of word by word.

A batch is one byte array with document offsets. Hashes of words and windows come from
prefix sums of ``value * BASE**position`` modulo 2**64, taken apart again with the inverse
power, and are then mixed; all are 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
CHUNK_BYTES = 1 << 20
# For many passes over arrays of eight bytes a byte of text, which then stay in a core's cache.
CACHED_BYTES = 1 << 18
_RANDOM = np.random.default_rng(20240607)
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
FOLDED_VALUE = BYTE_VALUE[_FOLD]
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 to base**(n-1), kept for the next batch."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[int(base)] = np.multiply.accumulate(steps)
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a hash (in place)."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class Prefix:
    """Hashes of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray) -> None:
        n = len(values)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * powers(BASE, n), out=self.sums[1:])
        self.back = powers(INVERSE, n + 1)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def windows(self, size: int) -> np.ndarray:
        """Hash of every ``size`` consecutive values."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self.sums[size:] - self.sums[:n]) * self.back[:n])


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``limit`` bytes; null is empty."""
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    body = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, body[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


class Words:
    """The words of a chunk: start and end bytes, hash, and each document's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, value: np.ndarray) -> None:
        held = inside[data]
        n = len(data)
        starts = held.copy()
        starts[1:] &= ~held[:-1]
        ends = held.copy()
        ends[:-1] &= ~held[1:]
        borders = offsets[1:-1]
        borders = borders[(borders > 0) & (borders < n)]
        starts[borders] = held[borders]
        ends[borders - 1] = held[borders - 1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.hash = Prefix(value[data]).stretch(self.start, self.end)
        # Number of words before each document, and in all.
        self.offsets = np.searchsorted(self.start, offsets)


def owner(offsets: np.ndarray) -> np.ndarray:
    """For each element, the document it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def sliding(values: np.ndarray, size: int, reduce: np.ufunc) -> np.ndarray:
    """``reduce`` over every ``size`` consecutive values, in a few passes whatever the size."""
    if len(values) < size:
        return values[:0]
    out, reach = values.copy() if size == 1 else values, 1
    while reach < size:
        # Two stretches that overlap make a longer one; whole passes take less time than running totals.
        step = min(reach, size - reach)
        out = reduce(out[:-step], out[step:])
        reach += step
    return out


class Anchors:
    """The anchors of every window of ``size`` elements: its least ``gram``-element hash.

    Equal windows have equal anchors, wherever they stand, so windows that may be equal
    meet at their anchors. ``least[s]`` is the anchor hash of the window at s, 0 where the
    window would leave its document; ``at`` lists the positions chosen by some window.
    """

    def __init__(self, prefix: Prefix, offsets: np.ndarray, size: int, gram: int) -> None:
        span = size - gram + 1
        n = int(offsets[-1])
        self.span, self.gram = span, gram
        hashes = prefix.windows(gram)
        if len(hashes) < span:
            self.least, self.at, self.hash = (np.zeros(0, np.uint64),) * 3
            self.at = self.at.astype(np.int64)
            return
        hashes |= np.uint64(1)
        least = sliding(hashes, span, np.minimum)
        # A window is whole if it ends within its document.
        lengths = np.diff(offsets)
        room = np.zeros(n + 1, dtype=np.int8)
        whole = lengths >= size
        np.add.at(room, offsets[:-1][whole], 1)
        np.add.at(room, offsets[1:][whole] - size + 1, -1)
        least[np.cumsum(room[: len(least)], dtype=np.int8) == 0] = 0
        reach = np.zeros(len(hashes) + span - 1, dtype=np.uint64)
        reach[span - 1 : span - 1 + len(least)] = least
        chosen = sliding(reach, span, np.maximum)[: len(hashes)] == hashes
        self.least = least
        self.at = np.flatnonzero(chosen)
        self.hash = hashes[self.at]

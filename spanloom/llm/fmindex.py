"""Substring dedup of words by a compressed FM-index per shard.

A shard's strings of words are joined, their suffixes sorted to the depth of a window, and
the Burrows-Wheeler transform kept as a wavelet tree of packed bits. Strings are streamed
from their end by backward search: an interval of rows is extended word by word; once it
has the length of a window, its last word is let go before the next one comes, so the
matching statistics never exceed a window, and every interval at full length is reported
with the earliest place it holds.

Defined results: null and blank texts have no words, keep nothing and remove nothing; texts
of fewer words than a window keep all; a document's own earlier windows count; rows with
one doc_id share their spans (ids are meant to be unique); null doc_ids are kept whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from spanloom.llm import repeats
from spanloom.llm.tokens import BYTE_VALUE, NOT_BLANK, Words

WINDOW, GRAM = 20, 8


def read_words(data: np.ndarray, offsets: np.ndarray) -> repeats.Symbols:
    words = Words(data, offsets, NOT_BLANK, BYTE_VALUE)
    return repeats.Symbols(words.hash, words.offsets, words.start, words.end)


class Wavelet:
    """Wavelet tree in levels, highest bit first: zeros of a level come before its ones."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        self.bits, self.levels, self.zeros = bits, [], []
        n = len(symbols)
        for b in range(bits - 1, -1, -1):
            bit = ((symbols >> b) & 1).astype(bool)
            padded = np.zeros((n // 64 + 1) * 64, dtype=np.uint8)
            padded[:n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.bitwise_count(words).astype(np.int64)
            self.levels.append((words, np.cumsum(counts) - counts))
            self.zeros.append(n - int(counts.sum()))
            symbols = np.r_[symbols[~bit], symbols[bit]]

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol above each row."""
        low = np.zeros(len(row), dtype=np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            words, counts = self.levels[level]
            one = ((symbol >> b) & 1).astype(bool)

            def ones(at: np.ndarray) -> np.ndarray:
                block = at >> 6
                mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
                return counts[block] + np.bitwise_count(words[block] & mask)

            a, r = ones(low), ones(row)
            low = np.where(one, self.zeros[level] + a, low - a)
            row = np.where(one, self.zeros[level] + r, row - r)
        return row - low


def earliest_places(values: np.ndarray, lengths: np.ndarray, least: np.ndarray, moving: int) -> np.ndarray:
    """Least place over all occurrences of each window of each string, by backward search."""
    alphabet, ids = np.unique(values, return_inverse=True)
    text, begin = repeats.joined(ids.ravel() + 1, lengths)
    n = len(text)
    order, new, shorter = repeats.depth_order(text, WINDOW, len(alphabet) + 1)
    place = repeats.window_places(lengths, begin, least, WINDOW, moving, n)
    group = np.flatnonzero(new)
    of_group = np.minimum.reduceat(place[order], group)
    near = np.r_[np.flatnonzero(shorter), n]
    tree = Wavelet(text[order - 1], int(len(alphabet) + 1).bit_length())
    counts = np.bincount(text, minlength=len(alphabet) + 2)
    smaller = np.cumsum(counts) - counts
    del order, place

    windows = lengths - WINDOW + 1
    base = np.cumsum(windows) - windows
    out = np.empty(int(windows.sum()), dtype=np.int64)
    queue = np.argsort(-windows, kind="stable")
    last = begin[queue] + lengths[queue] - 1
    lo, hi = np.zeros(len(queue), np.int64), np.full(len(queue), n, np.int64)
    for k in range(int(lengths.max()) if len(lengths) else 0):
        # Matching statistics: k + 1 words, a window at most.
        busy = int(np.searchsorted(-lengths[queue], -k, side="left"))
        lo, hi, mine = lo[:busy], hi[:busy], queue[:busy]
        symbol = text[last[:busy] - k]
        if k >= WINDOW:
            at = np.searchsorted(near, lo, side="right")
            lo, hi = near[at - 1], near[at]
        lo = smaller[symbol] + tree.rank(symbol, lo)
        hi = smaller[symbol] + tree.rank(symbol, hi)
        if k >= WINDOW - 1:
            out[base[mine] + lengths[mine] - 1 - k] = of_group[np.searchsorted(group, lo, side="right") - 1]
    return out


RULE = repeats.Rule(WINDOW, GRAM, True, read_words, earliest_places, 6)


def _cut(body: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int, str]:
    # bytes.split() cuts at space, tab, line feed, vertical tab, form feed and carriage return.
    words = body.split()
    keep, at = [], 0
    for a, b in zip(lo.tolist(), hi.tolist()):
        keep += words[at:a]
        at = b
    keep += words[at:]
    return len(words), int((hi - lo).sum()), hashlib.sha256(b" ".join(keep)).hexdigest()


def repeated_words(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bits: int | None = None,
    hot_strings: int = repeats.HOT_STRINGS,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): one row for each document."""
    spans = repeats.covered(docs, RULE, doc_id=doc_id, text=text, bucket_bits=bucket_bits, hot_strings=hot_strings)
    return repeats.cut_texts(
        docs, spans, _cut, "n_words long, n_removed long, kept_sha256 string", doc_id=doc_id, text=text
    )

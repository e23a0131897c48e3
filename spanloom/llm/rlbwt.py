"""Suffix-array dedup of bytes by a run-length index.

A shard's strings are joined, their suffixes sorted to the depth of a window, and the
Burrows-Wheeler transform kept as runs, with the text position sampled at both ends of each
run. Every string is then streamed from its end: backward search on the runs finds the rows
of its last window; for each further byte to the left, a row of the current group is
followed if it carries that byte, else the nearest sampled run end that does, and the match
goes on. A window of a document is covered if the group that its match reaches holds a place
in a document with a smaller id. Where a sample was used, its position is an occurrence of
the window, and bytes of the two are compared.

Defined results: null and empty texts have no bytes; texts shorter than a window keep all;
rows with one doc_id share their spans (ids are meant to be unique); null doc_ids are kept
whole; documents never repeat themselves, whatever is in them.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from spanloom.llm import repeats
from spanloom.llm.tokens import BYTE_VALUE

WINDOW, GRAM = 50, 16
_OF_VALUE = np.argsort(BYTE_VALUE)
_SORTED = BYTE_VALUE[_OF_VALUE]


def read_bytes(data: np.ndarray, offsets: np.ndarray) -> repeats.Symbols:
    return repeats.Symbols(BYTE_VALUE[data], offsets, None, None)


class RunIndex:
    """Runs of the transform: by position, and by symbol for rank queries."""

    def __init__(self, text: np.ndarray, order: np.ndarray) -> None:
        n = len(text)
        bwt = text[order - 1]  # position 0 is preceded by the last 0
        starts = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        ends = np.r_[starts[1:], n] - 1
        self.symbol = bwt[starts].astype(np.int64)
        self.starts = starts
        # Sampled at the ends of each run: where its first and last row stand in the text.
        self.first_at, self.last_at = order[starts], order[ends]
        self.by = np.argsort(self.symbol, kind="stable")
        self.stride = n + 1
        self.key = self.symbol[self.by] * self.stride + starts[self.by]
        self.begin, self.end = starts[self.by], ends[self.by]
        lengths = self.end - self.begin + 1
        # Rows before the run's first, among rows that begin with its symbol, plus where those begin.
        self.before = np.cumsum(lengths) - lengths
        self.total = np.r_[self.before, n]
        # Of each symbol: its first run, and the last symbol's end.
        self.first_run = np.searchsorted(self.key, np.arange(int(text.max()) + 2, dtype=np.int64) * self.stride)
        # Of each row: its run. A lookup here is a quarter of a search among the starts.
        place = np.empty(len(starts), dtype=np.int32)
        place[self.by] = np.arange(len(starts), dtype=np.int32)
        self.at = np.repeat(place, ends - starts + 1)
        self.carried = self.symbol[self.by]
        self.shift = self.before - self.begin

    def run_of(self, row: np.ndarray) -> np.ndarray:
        """The run a row lies in, by symbol order."""
        return self.at[row]

    def above(self, symbol: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last run of each symbol that begins above a row, and whether there is one."""
        run = np.searchsorted(self.key, symbol * self.stride + row, side="left") - 1
        return run, run >= self.first_run[symbol]

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Rows of smaller symbols, and of this symbol above ``row``: where the search goes on."""
        run, held = self.above(symbol, row)
        inside = np.minimum(row - self.begin[run], self.end[run] - self.begin[run] + 1)
        return np.where(held, self.before[run] + inside, self.total[self.first_run[symbol]])

    def narrow(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``step`` at both ends of intervals; most lie in one run of the symbol, which moves as a whole."""
        run = self.at[np.minimum(lo, len(self.at) - 1)]
        low = lo + self.shift[run]
        high = low + (hi - lo)
        rest = np.flatnonzero((self.carried[run] != symbol) | (self.end[run] < hi - 1))
        low[rest] = self.step(symbol[rest], lo[rest])
        high[rest] = self.step(symbol[rest], hi[rest])
        return low, high


def earliest_places(values: np.ndarray, lengths: np.ndarray, least: np.ndarray, moving: int) -> np.ndarray:
    """Least place over all occurrences of each window of each string, by streaming the strings."""
    ids = _OF_VALUE[np.searchsorted(_SORTED, values)] + 1
    text, begin = repeats.joined(ids, lengths)
    n = len(text)
    # Bytes that occur, numbered in order: the fewer bits each takes, the fewer sorts.
    present = np.zeros(257, dtype=bool)
    present[text] = True
    text = (np.cumsum(present) - 1).astype(np.int16)[text]
    order, new, shorter = repeats.depth_order(text, WINDOW, int(present.sum()) - 1)
    place = repeats.window_places(lengths, begin, least, WINDOW, moving, n)
    of_group = np.minimum.reduceat(place[order], np.flatnonzero(new))
    group = np.cumsum(new) - 1
    near = np.flatnonzero(shorter)[np.cumsum(shorter) - 1]
    index = RunIndex(text, order)
    del order, place, new, shorter

    windows = lengths - WINDOW + 1
    base = np.cumsum(windows) - windows
    out = np.empty(int(windows.sum()), dtype=np.int64)
    # All strings in step; the longest first, so that those at work stay in front.
    queue = np.argsort(-windows, kind="stable")
    shrinking = -windows[queue]
    last = begin[queue] + lengths[queue] - 1
    lo, hi = np.zeros(len(queue), np.int64), np.full(len(queue), n, np.int64)
    for k in range(WINDOW):
        symbol = text[last - k].astype(np.int64)
        lo, hi = index.narrow(symbol, lo, hi)
    if (hi <= lo).any():
        raise AssertionError("a string of the index was not found in it")
    row = lo
    out[base[queue] + windows[queue] - 1] = of_group[group[row]]
    for k in range(1, int(windows.max()) if len(windows) else 0):
        busy = int(np.searchsorted(shrinking, -k, side="left"))
        row = row[:busy]
        symbol = text[last[:busy] - (WINDOW - 1) - k].astype(np.int64)
        run = index.run_of(row)
        jump = np.flatnonzero((run < index.first_run[symbol]) | (run >= index.first_run[symbol + 1]))
        if len(jump):
            # The last run of the symbol above the row if it ends within the group, else the next one.
            c, r = symbol[jump], row[jump]
            chosen, held = index.above(c, r)
            fits = held & (index.end[chosen] >= near[r])
            chosen = np.where(fits, chosen, chosen + 1)
            row = row.copy()
            row[jump] = np.where(fits, index.end[chosen], index.begin[chosen])
            run[jump] = chosen
            sample = np.where(fits, index.last_at[index.by[chosen]], index.first_at[index.by[chosen]])
            # The exact check: bytes of the sampled occurrence are the window's.
            at, own = sample - 1, last[jump] - (WINDOW - 1) - k
            for step in (0, GRAM, WINDOW - 1):
                if (text[at + step] != text[own + step]).any():
                    raise AssertionError("a match of the run-length index differs from its window")
        row = row + index.shift[run]
        mine = queue[:busy]
        out[base[mine] + windows[mine] - 1 - k] = of_group[group[row]]
    return out


RULE = repeats.Rule(WINDOW, GRAM, False, read_bytes, earliest_places, 1)


def _cut(body: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int, int, str]:
    keep, at = hashlib.sha256(), 0
    for a, b in zip(lo.tolist(), hi.tolist()):
        keep.update(body[at:a])
        at = b
    keep.update(body[at:])
    return len(body), int((hi - lo).sum()), len(lo), keep.hexdigest()


def repeated_bytes(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bits: int | None = None,
    hot_strings: int = repeats.HOT_STRINGS,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): one row for each document."""
    spans = repeats.covered(docs, RULE, doc_id=doc_id, text=text, bucket_bits=bucket_bits, hot_strings=hot_strings)
    fields = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return repeats.cut_texts(docs, spans, _cut, fields, doc_id=doc_id, text=text)

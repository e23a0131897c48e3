"""Repeated stretches of symbols across documents: the frame of the two substring operators.

A window of ``size`` symbols (bytes or words) is repeated if it also starts earlier. Windows
meet at their anchors (``tokens.Anchors``): equal windows have equal anchors, so only
anchors that occur twice matter (``features``), and only the runs of windows around those
travel, as short strings, to the shard of their anchor. A shard keeps each distinct string
once, indexes them, streams them through the index, and reports the covered places. Hot
passages are one string of the index, whatever the number of their copies; a batch sends a
string once, with the list of its places.

A short line that many documents have between differing neighbours is one anchor with as
many strings. Anchors found ``HOT_STRINGS`` times are looked at again, and those with more
distinct strings than that are heavy: their windows travel one by one to the shard of the
whole window's hash, and only those that occur twice. Equal windows have equal anchors and
equal hashes, so they still meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import materialize
from spanloom.llm.features import ID_BITS, bucket_bits_for, shared_features
from spanloom.llm.tokens import CACHED_BYTES, Anchors, Prefix, chunks

SHARD_SYMBOLS = 1 << 20
RUN_WINDOWS = 64
PIECE_WINDOWS = 1 << 18
HOT_STRINGS = 1 << 13
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Symbols:
    """A chunk as symbols: values to hash, document offsets in symbols, first and end byte of each."""

    values: np.ndarray
    offsets: np.ndarray
    start: np.ndarray | None  # None: symbols are the bytes
    end: np.ndarray | None


# Chunk -> symbols; index of a shard: (strings as ids, lengths, least place of each) -> least place of each window
Read = Callable[[np.ndarray, np.ndarray], Symbols]
Earliest = Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


@dataclass(frozen=True)
class Rule:
    """What counts: window and anchor length in symbols, and whether a document repeats itself."""

    size: int
    gram: int
    within: bool
    read: Read
    earliest: Earliest
    bytes_of_symbol: int


def _anchor_features(rule: Rule):
    def extract(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        symbols = rule.read(data, offsets)
        anchors = Anchors(Prefix(symbols.values), symbols.offsets, rule.size, rule.gram)
        rows = np.searchsorted(symbols.offsets, anchors.at, side="right") - 1
        return anchors.hash, rows, np.diff(symbols.offsets)

    return extract


def _listed(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values a sorted table has."""
    if not len(table):
        return np.zeros(len(values), dtype=bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _heavy_windows(rule: Rule, heavy):
    """Whole windows at heavy anchors, as features."""

    def extract(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        symbols, prefix, begin, end, row, feature = _runs(rule, data, offsets)
        at, row, feature = _single(rule, prefix, begin, end, row, feature, heavy.value)
        return feature << np.uint64(ID_BITS), row, np.diff(symbols.offsets)

    return extract


def _strings_of_hot(rule: Rule, hot):
    """Rows (feature, string): hot anchors and the hashes of the strings around them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in chunks(batch.column("text"), CACHED_BYTES):
                _, prefix, begin, end, _, feature = _runs(rule, data, offsets)
                mine = _listed(feature, hot.value)
                begin, end, feature = begin[mine], end[mine] - 1 + rule.size, feature[mine]
                both = np.unique(np.stack([feature, prefix.stretch(begin, end)], axis=1), axis=0).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["feature", "string"])

    return run


def _heavy_anchors(source: DataFrame, found: DataFrame, rule: Rule, bound: int) -> np.ndarray:
    """Sorted features of the anchors with more than ``bound`` distinct strings.

    The driver holds at most one for each ``bound`` places of anchors in the texts.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(mine)], names=["feature"])

    def sorted_features(rows: DataFrame) -> np.ndarray:
        return np.sort(np.array([r.feature for r in rows.select("feature").collect()], dtype=np.uint64))

    hot = sorted_features(found.where("octet_length(hot) > 0").select("hot").mapInArrow(each, "feature long").distinct())
    if not len(hot):
        return hot
    share = source.sparkSession.sparkContext.broadcast(hot)
    strings = source.mapInArrow(_strings_of_hot(rule, share), "feature long, string long").distinct()
    return sorted_features(strings.groupBy("feature").count().where(F.col("count") > bound))


def _strings(rule: Rule, shards: int, heavy, single: bool):
    """Rows (shard, places, lengths, body) of the joined documents: runs of windows at shared anchors.

    Of the anchors that are not heavy, or (``single``) the shared windows at heavy ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            shared = batch.column("shared")
            # Each distinct string of the batch goes out once, with the list of its places.
            number: dict[bytes, int] = {}
            shard_of: list[int] = []
            string, doc, start = [], [], []
            for first, data, offsets in chunks(batch.column("text"), CACHED_BYTES):
                runs = _shared_runs(rule, data, offsets, shared.slice(first, len(offsets) - 1), heavy.value, single)
                if runs is None:
                    continue
                low, high, row, begin, feature = runs
                shard = (feature % np.uint64(shards)).astype(np.int64)
                body = data.tobytes()
                mine = []
                for a, b, at in zip(low.tolist(), high.tolist(), shard.tolist()):
                    n = number.setdefault(body[a:b], len(shard_of))
                    if n == len(shard_of):
                        shard_of.append(at)
                    mine.append(n)
                string.append(np.array(mine, dtype=np.int64))
                doc.append(ids[first + row])
                start.append(begin)
            if not shard_of:
                continue
            string, doc, start = map(np.concatenate, (string, doc, start))
            shard = np.array(shard_of)
            order = np.argsort(shard, kind="stable")
            rank = np.empty(len(order), dtype=np.int64)
            rank[order] = np.arange(len(order))
            by_rank = np.argsort(rank[string], kind="stable")
            ranks = rank[string][by_rank]
            texts = list(number)
            cuts = np.flatnonzero(np.r_[True, np.diff(shard[order]) > 0, True])
            out = []
            for a, b in zip(cuts, cuts[1:]):
                x, y = np.searchsorted(ranks, [a, b])
                who = by_rank[x:y]
                held = [texts[i] for i in order[a:b]]
                places = np.concatenate([ranks[x:y] - a, doc[who], start[who]]).astype(np.int64)
                lengths = np.array([len(t) for t in held], dtype=np.int32)
                out.append((int(shard[order[a]]), _squeezed(places), _squeezed(lengths), _squeezed(b"".join(held))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int32()),
                    *(pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3)),
                ],
                names=["shard", "places", "lengths", "body"],
            )

    return run


def _squeezed(data: np.ndarray | bytes) -> bytes:
    """Compressed, behind its length. Numbers go plane by plane."""
    if isinstance(data, np.ndarray):
        data = np.ascontiguousarray(data.view(np.uint8).reshape(len(data), -1).T).tobytes()
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _loose(data: bytes, kind: type | None = None) -> np.ndarray | bytes:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    if kind is None:
        return raw
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _runs(rule: Rule, data: np.ndarray, offsets: np.ndarray) -> tuple:
    """Symbols, their prefix, and runs of windows with one anchor: first and end window, row, feature."""
    symbols = rule.read(data, offsets)
    prefix = Prefix(symbols.values)
    least = Anchors(prefix, symbols.offsets, rule.size, rule.gram).least
    if not len(least):
        nothing = np.zeros(0, dtype=np.int64)
        return symbols, prefix, nothing, nothing, nothing, nothing.astype(np.uint64)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(symbols.offsets))[: len(least)]
    border = np.r_[True, (least[1:] != least[:-1]) | (row_of[1:] != row_of[:-1])]
    begin = np.flatnonzero(border)
    # Periodic text keeps one anchor for long; its runs are cut, so that strings stay short.
    pieces = -(-np.diff(np.r_[begin, len(least)]) // RUN_WINDOWS)
    inner = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = np.repeat(begin, pieces) + inner * RUN_WINDOWS
    end = np.r_[begin[1:], len(least)]
    whole = least[begin] > 0
    begin, end = begin[whole], end[whole]
    return symbols, prefix, begin, end, row_of[begin], least[begin] >> np.uint64(ID_BITS)


def _single(
    rule: Rule, prefix: Prefix, begin: np.ndarray, end: np.ndarray, row: np.ndarray, feature: np.ndarray, heavy: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each window of the runs at heavy anchors: where it begins, its row, its own feature."""
    mine = _listed(feature, heavy)
    begin, n, row = begin[mine], (end - begin)[mine], row[mine]
    at = np.repeat(begin, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    return at, np.repeat(row, n), prefix.stretch(at, at + rule.size) >> np.uint64(ID_BITS)


def _shared_runs(rule: Rule, data: np.ndarray, offsets: np.ndarray, shared: pa.Array, heavy: np.ndarray, single: bool) -> tuple | None:
    """Runs of windows with one shared anchor: first and end byte, row, first symbol in it, feature.

    Without those at heavy anchors; or (``single``) the shared windows at heavy anchors alone.
    """
    symbols, prefix, begin, end, row, feature = _runs(rule, data, offsets)
    if single:
        begin, row, feature = _single(rule, prefix, begin, end, row, feature, heavy)
        end = begin + 1
    elif len(heavy):
        light = ~_listed(feature, heavy)
        begin, end, row, feature = begin[light], end[light], row[light], feature[light]
    if not len(begin):
        return None
    rows = len(offsets) - 1
    known = [np.frombuffer(s.as_py(), np.uint32) for s in shared]
    owner = np.repeat(np.arange(rows), [len(k) for k in known])
    # One search for all rows: the row above the feature's low bits.
    table = np.sort((owner.astype(np.uint64) << np.uint64(32)) | np.concatenate(known))
    key = (row.astype(np.uint64) << np.uint64(32)) | (feature & np.uint64(0xFFFFFFFF))
    at = np.minimum(np.searchsorted(table, key), max(len(table) - 1, 0))
    held = table[at] == key if len(table) else np.zeros(len(key), bool)
    begin, end, row, feature = begin[held], end[held] - 1 + rule.size, row[held], feature[held]
    if not len(begin):
        return None
    low = begin if symbols.start is None else symbols.start[begin]
    high = end if symbols.end is None else symbols.end[end - 1]
    return low, high, row, begin - symbols.offsets[row], feature


def _resolve(rule: Rule):
    """Of one shard: (doc_id, lo, hi), the symbols covered by windows that start earlier elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        texts: list[bytes] = []
        which, docs, starts = [], [], []
        for places, lengths, body in zip(*(table.column(c).to_pylist() for c in ("places", "lengths", "body"))):
            sizes, body = _loose(lengths, np.int32), _loose(body)
            edges = np.r_[0, np.cumsum(sizes)]
            mine = np.empty(len(sizes), dtype=np.int64)
            for i in range(len(sizes)):
                text = body[edges[i] : edges[i + 1]]
                at = number.setdefault(text, len(texts))
                if at == len(texts):
                    texts.append(text)
                mine[i] = at
            local, doc, start = _loose(places, np.int64).reshape(3, -1)
            which.append(mine[local])
            docs.append(doc)
            starts.append(start)
        which, docs, starts = map(np.concatenate, (which, docs, starts))
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        offsets = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
        symbols = rule.read(data, offsets)
        lengths = np.diff(symbols.offsets)
        # Places in order; the first place of each string is the least.
        order = np.lexsort((starts, docs))
        which, docs, starts = which[order], docs[order], starts[order]
        strings, first = np.unique(which, return_index=True)
        doc_rank = np.r_[0, np.cumsum(docs[1:] != docs[:-1])]
        least = np.empty(len(lengths), dtype=np.int64)
        if rule.within:
            # Document above start, so that the earliest place is the least number.
            wide = int(starts.max()) + int(lengths.max()) + 1
            place = doc_rank * wide + starts
            least[strings] = place[first]
            earliest = rule.earliest(symbols.values, lengths, least, 1)
        else:
            place = doc_rank
            least[strings] = place[first]
            earliest = rule.earliest(symbols.values, lengths, least, 0)
        windows = lengths - rule.size + 1
        base = np.cumsum(windows) - windows
        # Every window of every place, in pieces of bounded size.
        out: list[tuple[np.ndarray, ...]] = []
        total = windows[which]
        piece = np.searchsorted(np.cumsum(total), np.arange(0, int(total.sum()) + 1, PIECE_WINDOWS))
        for a, b in zip(piece, np.r_[piece[1:], len(which)]):
            if a == b:
                continue
            n = total[a:b]
            owner = np.repeat(np.arange(a, b), n)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            mine = place[owner] + (inner if rule.within else 0)
            gone = earliest[base[which[owner]] + inner] < mine
            owner, inner = owner[gone], inner[gone]
            if not len(owner):
                continue
            fresh = np.r_[True, (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)]
            lo = np.flatnonzero(fresh)
            hi = np.r_[lo[1:], len(owner)] - 1
            begin = starts[owner[lo]] + inner[lo]
            out.append((docs[owner[lo]], begin, starts[owner[hi]] + inner[hi] + rule.size))
        if not out:
            out = [(np.zeros(0, np.int64),) * 3]
        return pa.table(
            {name: pa.array(np.concatenate([o[i] for o in out]), pa.int64()) for i, name in enumerate(("doc_id", "lo", "hi"))}
        )

    return run


def depth_order(symbols: np.ndarray, depth: int, widest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``depth`` symbols, by prefix doubling.

    Returns the order and, row by row, whether a row begins a new group at ``depth`` and at
    ``depth - 1`` symbols. Sorting packs rank and position in one integer where they fit.
    """
    n = len(symbols)
    bits = max(1, int(n).bit_length())
    width = max(1, int(widest).bit_length())
    take = max(1, min(depth - 1, (63 - bits) // width))
    kind = np.uint32 if n < 1 << 31 else np.uint64

    def ranks(at: np.ndarray, new: np.ndarray) -> np.ndarray:
        out, number = np.empty(n, dtype=kind), np.cumsum(new, dtype=kind)
        number -= 1
        out[at] = number
        return out

    def ordered(high: np.ndarray, low: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Order by (high, low), and the rows' equality with the row before."""
        # In place: arrays as long as the text that come and go cost more than what is done to them.
        key = high.astype(np.uint64)
        if shift:
            key <<= np.uint64(shift)
            key |= low
        if shift + shift + bits <= 64 or shift == 0:
            key <<= np.uint64(bits)
            key |= np.arange(n, dtype=np.uint64)
            key.sort()
            at = (key & np.uint64((1 << bits) - 1)).view(np.int64)
            key >>= np.uint64(bits)
            same = key[1:] == key[:-1]
        else:
            at = np.argsort(key, kind="stable")
            same = key[at[1:]] == key[at[:-1]]
        return at, np.r_[True, ~same]

    def ahead(values: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, dtype=kind)
        if by < n:
            np.add(values[by:], 1, out=out[: n - by])
        return out

    first = np.zeros(n, dtype=np.uint64)
    for k in range(take):
        first <<= np.uint64(width)
        first[: n - k] |= symbols[k:].astype(np.uint64)
    at, new = ordered(first, first, 0)
    rank = ranks(at, new)
    reach = take
    while reach < depth:
        step = min(reach, depth - reach)
        before, before_reach = rank, reach
        at, new = ordered(rank, ahead(rank, step), bits)
        rank = ranks(at, new)
        reach += step
    if depth == 1:
        return at, new, np.arange(n) == 0
    # At depth - 1 two rows are equal if both overlapping halves are.
    shorter = ahead(before, depth - 1 - before_reach) if depth - 1 > before_reach else before
    a, b = at[1:], at[:-1]
    return at, new, np.r_[True, (before[a] != before[b]) | (shorter[a] != shorter[b])]


def joined(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of ids above 0, each closed by a 0, and where each begins."""
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    text = np.zeros(int(lengths.sum()) + len(lengths), dtype=np.int64)
    inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    text[np.repeat(begin, lengths) + inner] = ids
    return text, begin


def window_places(lengths: np.ndarray, begin: np.ndarray, least: np.ndarray, size: int, moving: int, n: int) -> np.ndarray:
    """For every text position, the place of the window there (LAST where there is none)."""
    windows = lengths - size + 1
    inner = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    place = np.full(n, LAST, dtype=np.int64)
    place[np.repeat(begin, windows) + inner] = np.repeat(least, windows) + moving * inner
    return place


def shard_strings(
    docs: DataFrame, rule: Rule, *, doc_id: str, text: str, bucket_bits: int | None, hot_strings: int
) -> DataFrame:
    """(shard, places, lengths, body): the strings that the shards compare."""
    source = plain(docs, doc_id, text)
    weight = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bucket_bits or bucket_bits_for(weight)
    options = dict(bucket_bits=bits, repeats_count=rule.within, low_bits_only=True)
    found = shared_features(source, _anchor_features(rule), hot=hot_strings, **options).where("n_shared > 0")
    found = materialize(found.select("doc_id", "shared", "hot"), "shared-anchors")
    shards = max(8, weight // (SHARD_SYMBOLS * rule.bytes_of_symbol))
    heavy = _heavy_anchors(source, found, rule, hot_strings)
    share = docs.sparkSession.sparkContext.broadcast(heavy)
    fields = "shard int, places binary, lengths binary, body binary"
    both = source.join(found.select("doc_id", "shared"), "doc_id")
    strings = both.mapInArrow(_strings(rule, shards, share, False), fields)
    if len(heavy):
        again = shared_features(source, _heavy_windows(rule, share), **options).where("n_shared > 0")
        both = source.join(again.select("doc_id", "shared"), "doc_id")
        strings = strings.unionByName(both.mapInArrow(_strings(rule, shards, share, True), fields))
    return strings


def covered(
    docs: DataFrame, rule: Rule, *, doc_id: str, text: str, bucket_bits: int | None, hot_strings: int = HOT_STRINGS
) -> DataFrame:
    """(doc_id, spans): the covered stretches of each document that has any, in symbols, unmerged."""
    strings = shard_strings(docs, rule, doc_id=doc_id, text=text, bucket_bits=bucket_bits, hot_strings=hot_strings)
    spans = strings.groupBy("shard").applyInArrow(_resolve(rule), "doc_id long, lo long, hi long")
    return spans.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def plain(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Ids and texts. Both joins with the texts start from this, so Spark shuffles them once.

    The id goes through an expression that changes nothing: Spark renames a plain column on
    one side of such a plan, and would not see that the two shuffles are the same.
    """
    same = F.bitwise_not(F.bitwise_not(F.col(doc_id).cast("long")))
    rows = docs.where(F.col(doc_id).isNotNull()).select(same.alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.where("doc_id is not null")  # the join would add this filter on one side only


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted spans joined where they overlap or touch."""
    if not len(lo):
        return lo, hi
    reach = np.maximum.accumulate(hi)
    fresh = np.r_[True, lo[1:] > reach[:-1]]
    begin = np.flatnonzero(fresh)
    return lo[begin], reach[np.r_[begin[1:], len(lo)] - 1]


def cut_texts(docs: DataFrame, spans: DataFrame, cut: Callable, fields: str, *, doc_id: str, text: str) -> DataFrame:
    """``docs`` joined with its spans, and what ``cut(text bytes, lo, hi)`` makes of each row."""
    both = plain(docs, doc_id, text).join(spans, "doc_id", "left")
    alone = docs.where(F.col(doc_id).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"), F.lit(None).cast(spans.schema["spans"].dataType).alias("spans")
    )
    both = both.unionByName(alone).select(
        "doc_id", F.col("text").alias("body"), F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi")
    )
    names = [f.strip().split(" ")[0] for f in fields.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, dtype=np.int64)
        for batch in batches:
            rows = []
            for body, lo, hi in zip(batch.column("body"), batch.column("lo"), batch.column("hi")):
                low = lo.values.to_numpy(zero_copy_only=False) if lo.is_valid else nothing
                high = hi.values.to_numpy(zero_copy_only=False) if hi.is_valid else nothing
                rows.append(cut(body.as_py() or b"", *merged(low, high)))
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c) for c in columns)], names=["doc_id", *names]
            )

    return both.mapInArrow(run, f"doc_id long, {fields}")

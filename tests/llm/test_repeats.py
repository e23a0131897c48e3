import collections
import random

import numpy as np
import pytest
from brute import repeated

from spanloom.llm import fmindex, queries, repeats, rlbwt
from spanloom.llm.tokens import Anchors, Prefix, sliding

BYTES = dict(size=50, split=lambda b: b, join=bytes, within=False)
WORDS = dict(size=20, split=lambda b: b.split(), join=b" ".join, within=True)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect() if r.doc_id is not None]


def got(df, n):
    rows = df.collect()
    return {r[0]: tuple(r[1:]) for r in rows if r[0] is not None}, len(rows)


@pytest.mark.parametrize("source", ["edge", "documents"])
def test_bytes_equal_brute_force(request, source):
    docs = request.getfixturevalue(source)
    found, n = got(rlbwt.repeated_bytes(docs), 4)
    assert found == repeated(pairs(docs), **BYTES) and n == docs.count()


@pytest.mark.parametrize("source", ["edge", "documents"])
def test_words_equal_brute_force(request, source):
    docs = request.getfixturevalue(source)
    found, n = got(fmindex.repeated_words(docs), 3)
    want = {k: (v[0], v[1], v[3]) for k, v in repeated(pairs(docs), **WORDS).items()}
    assert found == want and n == docs.count()


def test_null_id_is_kept_whole(edge):
    row = rlbwt.repeated_bytes(edge).where("doc_id is null").first()
    assert row.n_removed == 0 and row.n_bytes > 0


def test_empty_table(nothing):
    assert rlbwt.repeated_bytes(nothing).count() == 0
    assert fmindex.repeated_words(nothing).count() == 0


def test_registered_queries(spark, sf_dir, documents):
    rows = queries.op2_runs(spark, sf_dir).collect()
    want = repeated(pairs(documents), **BYTES)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    rows = queries.op4_substrings(spark, sf_dir).collect()
    want = repeated(pairs(documents), **WORDS)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == {
        k: (v[0], v[1], v[3]) for k, v in want.items()
    }


def test_anchors_of_equal_windows_are_equal():
    rng = np.random.default_rng(1)
    values = rng.integers(1, 2**63, 5, dtype=np.uint64)[rng.integers(0, 5, 4000)]
    offsets = np.array([0, 700, 730, 730, 4000])
    anchors = Anchors(Prefix(values), offsets, 30, 8)
    chosen = set(anchors.at.tolist())
    for s in range(4000 - 29):
        inside = any(a <= s and s + 30 <= b for a, b in zip(offsets, offsets[1:]))
        if not inside:
            assert anchors.least[s] == 0 if s < len(anchors.least) else True
        else:
            assert any(p in chosen for p in range(s, s + 23))


def test_depth_order_sorts_and_groups():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(1, 4, 3000), 0]
    for depth in (1, 2, 7, 20, 50):
        order, new, shorter = repeats.depth_order(text, depth, 3)
        keys = [tuple(text[i : i + depth]) for i in order]
        assert keys == sorted(keys)
        assert [a != b for a, b in zip(keys[1:], keys)] == new[1:].tolist()
        assert [a[: depth - 1] != b[: depth - 1] for a, b in zip(keys[1:], keys)] == shorter[1:].tolist()


def test_wavelet_rank():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 37, 1000)
    tree = fmindex.Wavelet(text, 6)
    symbol, row = rng.integers(0, 37, 200), rng.integers(0, 1001, 200)
    assert tree.rank(symbol, row).tolist() == [int((text[:r] == s).sum()) for s, r in zip(symbol, row)]


def test_run_index_step_counts_smaller_and_equal():
    rng = np.random.default_rng(4)
    text = np.repeat(rng.integers(1, 5, 200), rng.integers(1, 9, 200))
    text = np.r_[text, 0]
    order, _, _ = repeats.depth_order(text, 50, 5)
    index, bwt = rlbwt.RunIndex(text, order), text[order - 1]
    symbol, row = rng.integers(0, 5, 300), rng.integers(0, len(text) + 1, 300)
    want = [int((bwt < s).sum() + (bwt[:r] == s).sum()) for s, r in zip(symbol, row)]
    assert index.step(symbol, row).tolist() == want
    far = np.minimum(row + rng.integers(0, 60, 300), len(text))
    low, high = index.narrow(symbol, row, far)
    assert low.tolist() == want and high.tolist() == index.step(symbol, far).tolist()


def short_line_rows(n):
    """A line shorter than a window in every document between its own words; some windows are shared."""
    rng = random.Random(12)
    own = ["".join(rng.choice("bcdfghjklm") for _ in range(7)) + " n%d" % i for i in range(n)]
    line = "a b c d e f g h i j k l m n o"
    both = [f"{' '.join(reversed(w.split()))} {w} x{w}\n{line}\ny{w} {w[::-1]} z{w}" for w in own]
    both[5] = both[2] + " tail"
    both[9] = "head " + both[7]
    both[11] = " ".join(both[4].split()[3:] + ["more"] + both[4].split())
    return list(enumerate(both))


@pytest.mark.parametrize("rule", ["bytes", "words"])
def test_short_line_of_all_documents_does_not_fill_a_shard(spark, rule):
    docs = spark.createDataFrame(short_line_rows(1200), "doc_id long, text string").repartition(4)
    module, n, want = (rlbwt, 4, BYTES) if rule == "bytes" else (fmindex, 3, WORDS)
    operator = rlbwt.repeated_bytes if rule == "bytes" else fmindex.repeated_words
    options = dict(doc_id="doc_id", text="text", bucket_bits=None)

    def fullest(hot):
        rows = repeats.shard_strings(docs, module.RULE, hot_strings=hot, **options).collect()
        held = collections.Counter()
        for r in rows:
            held[r.shard] += len(repeats._loose(r.lengths, np.int32))
        return max(held.values())

    assert fullest(100) < 200 < 400 < fullest(1 << 13)
    expected = repeated(pairs(docs), **want)
    if rule == "words":
        expected = {k: (v[0], v[1], v[3]) for k, v in expected.items()}
    assert got(operator(docs, hot_strings=100), n)[0] == expected
    assert sum(v[1] > 0 for v in expected.values()) >= 2


@pytest.mark.parametrize("source", ["edge", "documents"])
def test_heavy_anchors_equal_brute_force(request, source):
    docs = request.getfixturevalue(source)
    assert got(rlbwt.repeated_bytes(docs, hot_strings=2), 4)[0] == repeated(pairs(docs), **BYTES)
    want = {k: (v[0], v[1], v[3]) for k, v in repeated(pairs(docs), **WORDS).items()}
    assert got(fmindex.repeated_words(docs, hot_strings=2), 3)[0] == want


def test_an_interval_within_one_run_moves_without_a_search(monkeypatch):
    rng = np.random.default_rng(5)
    word = rng.integers(1, 4, 60)
    text = np.concatenate([np.r_[word, rng.integers(1, 4, 5), 0] for _ in range(40)])
    order = repeats.depth_order(text, 50, 4)[0]
    index, bwt = rlbwt.RunIndex(text, order), text[order - 1]
    rows = np.arange(len(text))
    assert (index.carried[index.run_of(rows)] == bwt).all()
    searched, above = [], index.above
    monkeypatch.setattr(index, "above", lambda symbol, row: searched.append(len(row)) or above(symbol, row))
    lo, hi = np.array([0]), np.array([len(text)])
    sizes = []
    for symbol in word[::-1]:
        held = [sum(bwt[:at] == symbol) + sum(text < symbol) for at in (int(lo[0]), int(hi[0]))]
        lo, hi = index.narrow(np.array([symbol]), lo, hi)
        assert [lo[0], hi[0]] == held
        sizes.append(int(hi[0] - lo[0]))
    assert sizes[-1] >= 40
    assert sum(searched) < len(word)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 35, 50])
def test_sliding_takes_every_stretch_in_whole_passes(size):
    values = np.random.default_rng(size).integers(0, 2**63, 50, dtype=np.uint64)
    passes = []

    def least(a, b):
        passes.append(len(a))
        return np.minimum(a, b)

    found = sliding(values, size, least)
    assert found.tolist() == [min(values[i : i + size]) for i in range(50 - size + 1)]
    assert len(passes) == (size - 1).bit_length() and not np.shares_memory(found, values)
    assert len(sliding(values, 51, least)) == 0

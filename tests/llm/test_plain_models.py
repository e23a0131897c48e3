"""The classifier's features, training and scores, and the placement in shards, in plain Python."""

import collections
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spanloom.llm import quality, sharding
from spanloom.llm.tokens import BASE, BYTE_VALUE

MASK = 2**64 - 1
BYTES = [int(v) for v in BYTE_VALUE]


def mixed(h):
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 & MASK
    h ^= h >> 29
    h = h * 0xBF58476D1CE4E5B9 & MASK
    return h ^ h >> 32


def word_hash(word):
    folded = [b + 32 if 65 <= b <= 90 else b for b in word]
    return mixed(sum(BYTES[b] * pow(int(BASE), k, 2**64) for k, b in enumerate(folded)) & MASK)


def kind(b):
    if b >= 128:
        return 32
    c = chr(b)
    return 1 if c.isupper() else 2 if c.islower() else 4 if c.isdigit() else 8 if c in ",." else 16


def shape(word, before, blank_after):
    """The kinds of a word's bytes count with the blanks that follow it."""
    out = 16 if blank_after else 0
    for b in word:
        out |= kind(b)
    twice = len(word) > 1 and word[-1] == word[-2]
    same = before is not None and word_hash(word) == word_hash(before)
    for part, width in ((kind(word[0]), 64), (kind(word[-1]), 64), (twice, 2), (same, 2), (min(len(word), 20) // 3, 8)):
        out = (out * width + int(part)) & MASK
    return mixed((out + (1 << 40)) & MASK)


def vector(text):
    """{weight: value} of a document."""
    body = (text or "").encode()
    found = list(re.finditer(rb"[^\x20\x09-\x0D]+", body))
    words = [m.group() for m in found]
    hashes = [word_hash(w) for w in words]
    shapes = [shape(w, words[k - 1] if k else None, found[k].end() < len(body)) for k, w in enumerate(words)]
    out = {}
    for values, size, salt in ((hashes, 1, 11), (hashes, 2, 12), (shapes, 1, 21), (shapes, 2, 22), (shapes, 3, 23)):
        grams = []
        for k in range(len(values) - size + 1):
            h = values[k]
            for v in values[k + 1 : k + size]:
                h = (h * 0x9E3779B97F4A7C15 + v) & MASK
            grams.append(mixed((h + salt) & MASK) >> (64 - quality.HASH_BITS))
        for index, n in collections.Counter(grams).items():
            out[index] = out.get(index, 0.0) + quality.SCALE * n / len(grams)
    return out


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-35, min(35, x))))


def plain_ftrl(examples, passes=4, batch=16, alpha=0.3, beta=1.0, l1=0.02, l2=0.1):
    """Weights of (vector, label) rows in their order; "bias" is a weight whose value is 1."""
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -math.copysign(abs(z[i]) - l1, z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(passes):
        for at in range(0, len(examples), batch):
            gradient, held = collections.defaultdict(float), {}
            for x, y in examples[at : at + batch]:
                x = {**x, "bias": 1.0}
                held.update({i: weight(i) for i in x})
                error = sigmoid(sum(held[i] * v for i, v in x.items())) - y
                for i, v in x.items():
                    gradient[i] += error * v
            for i, g in gradient.items():
                after = n[i] + g * g
                z[i] += g - (math.sqrt(after) - math.sqrt(n[i])) / alpha * held[i]
                n[i] = after
    return {i: weight(i) for i in n}


def labelled(n=90):
    rng = random.Random(12)
    rows = []
    for i in range(n):
        good = i % 2
        pool = ["The", "river", "was", "calm,", "and", "we", "walked.", "Ärger"] if good else ["BUY", "now!!", "$$$", "win", "win", "99", "clickk"]
        # The first word is never the last one of another document.
        rows.append((i, f"d{i} " + " ".join(rng.choice(pool) for _ in range(rng.randint(3, 30))), good))
    return rows


def test_training_and_scores_equal_plain_ftrl(spark):
    rows = labelled()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    model = quality.train(docs, labels, learners=1)
    seen = {r[0] for r in labels.where(~quality.held_out(F.col("doc_id"))).select("doc_id").collect()}
    assert 0 < len(seen) < len(rows)
    order = sorted((r for r in rows if r[0] in seen), key=lambda r: mixed((r[0] + 77) & MASK))
    want = plain_ftrl([(vector(text), y) for _, text, y in order])
    bias = want.pop("bias")
    assert model.bias == pytest.approx(bias, abs=1e-5)
    used = np.flatnonzero(model.weights)
    assert set(used.tolist()) == {i for i, w in want.items() if w} and len(used) > 100
    assert all(model.weights[i] == pytest.approx(want[i], abs=1e-5) for i in used)
    for r in quality.score_documents(docs, model).collect():
        margin = bias + sum(want.get(i, 0.0) * v for i, v in vector(r.text).items())
        assert r.score == pytest.approx(sigmoid(margin), abs=1e-5)


def test_a_score_does_not_depend_on_the_neighbours(spark):
    """A document that begins with the last word of the one before it, or with blanks."""
    rng = np.random.default_rng(5)
    model = quality.Model(rng.normal(size=1 << quality.HASH_BITS), 0.1)
    texts = ["one two", "two three", "  \n four five", "", "five", "  ", "five six "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for r in quality.score_documents(docs, model).collect():
        margin = model.bias + sum(model.weights[i] * v for i, v in vector(r.text).items())
        assert r.score == pytest.approx(sigmoid(margin), abs=1e-9)


def test_shards_equal_plain_placement(spark):
    """All rows on one line of bytes in order of (hash, id); a group of equal texts goes by its middle."""
    rng = random.Random(9)
    rows = []
    for i in range(500):
        text = " ".join(rng.choice(["alpha", "beta", "gamma", "é"]) for _ in range(rng.randint(1, 40))) + f" {i}"
        rows += [(len(rows) + k, text) for k in range(rng.choice([1, 1, 1, 2, 3]))]
    rows += [(None, "no id"), (10_000, None), (10_001, ""), (10_002, "twice"), (10_002, "twice")]
    shards = 6
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.shard_documents(docs, shards).collect()

    def key(row):
        h = xxhash.xxh64((row[1] or "").encode(), seed=42).intdigest()
        return (h - 2**64 if h >= 2**63 else h, -(2**63) if row[0] is None else row[0])

    line = sorted(rows, key=key)
    size = [len((t or "").encode()) + sharding.ROW_BYTES for _, t in line]
    total, at, starts = sum(size), 0, []
    for s in size:
        starts.append(at)
        at += s
    groups = collections.defaultdict(list)
    for k, row in enumerate(line):
        groups[key(row)[0]].append(k)
    want, used = [], collections.Counter()
    for k, row in enumerate(line):
        group = groups[key(row)[0]]
        all_bytes = sum(size[j] for j in group)
        whole = all_bytes <= 0.1 * total / shards
        middle = starts[group[0]] + all_bytes / 2 if whole else starts[k] + size[k] / 2
        shard = min(shards - 1, int(middle * shards // total))
        want.append((row[0], row[1], shard, used[shard]))
        used[shard] += 1
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.text, r.shard, r.slot)) for r in found)

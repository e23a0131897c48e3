import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanloom.llm import licences, neighbours, pages, quality, queries


def test_quality_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op1_quality(spark, sf_dir).toPandas()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas().merge(rows, on="doc_id")
    assert rows.score.between(0, 1).all() and ((rows.score >= 0.3) == (rows.predicted == 1)).all()
    test = labels[labels.held_out]
    good, bad = test[test.quality == 1].score.to_numpy(), test[test.quality == 0].score.to_numpy()
    auc = np.mean(good[:, None] > bad[None, :]) + np.mean(good[:, None] == bad[None, :]) / 2
    assert auc > 0.97 and (good >= 0.3).mean() > 0.98
    again = queries.op1_quality(spark, sf_dir).toPandas()
    assert rows.set_index("doc_id").score.equals(again.set_index("doc_id").score.loc[rows.doc_id])


def test_quality_never_learns_from_held_out_labels(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    flipped = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a, b = quality.train(documents, labels), quality.train(documents, flipped)
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_quality_edges(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (5, 1), (5, 0), (99, 0)], "doc_id long, quality int")
    model = quality.train(edge, labels)
    scored = quality.score_documents(edge, model)
    assert scored.columns == [c for c in edge.columns if c != "score"] + ["score"]
    rows = scored.collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if not (r.text or "").strip()}
    assert len(empty) == 1
    none = quality.train(edge, labels.limit(0))
    assert {r.score for r in quality.score_documents(edge, none).collect()} == {0.5}
    assert quality.score_documents(nothing, model).count() == 0
    assert quality.keep_good(edge, labels.limit(0)).columns == edge.columns


def vectors(spark, rows, name="array<float>"):
    return spark.createDataFrame(rows, f"vec_id long, embedding {name}, label int, component_id string")


def exact(ids, unit, threshold):
    links = (unit @ unit.T >= threshold) & ~np.eye(len(ids), dtype=bool)
    label = np.arange(len(ids))
    while True:
        new = np.array([min(label[i], label[links[i]].min() if links[i].any() else label[i]) for i in range(len(ids))])
        if (new == label).all():
            return links.sum(1), label
        label = new


@pytest.mark.parametrize("cells", [1, 12])
def test_neighbours_equal_brute_force(spark, cells):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 24)).astype(np.float32)
    for i in range(300, 600):
        x[i] = x[rng.integers(0, 40)] + rng.normal(size=24) * rng.choice([0.02, 0.1, 0.2])
    x[600:620] = x[5]
    rows = [(int(i), [float(v) for v in r], 0, "x") for i, r in enumerate(x)]
    found = neighbours.near_vectors(vectors(spark, rows).repartition(4), cell_rows=900 // cells, block_rows=64)
    found = found.toPandas().set_index("vec_id").sort_index()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    n, label = exact(np.arange(900), unit, 0.95)
    # Pairs that cells part would be lost; what is found is right, and nearly all is found.
    assert (found.n_links.to_numpy() <= n).all()
    assert found.n_links.sum() >= 0.99 * n.sum()
    assert (found.kept == (found.index == found.component_id)).all()
    if cells == 1:
        assert (found.n_links.to_numpy() == n).all() and (found.component_id.to_numpy() == label).all()


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 0, "a"), (2, [], 0, "a"), (3, [0.0, 0.0], 0, "a"), (4, [1.0, nan], 0, "a"), (5, [inf, 1.0], 0, "a"),
        (6, [1.0, None], 0, "a"), (7, [1.0, 0.0], 0, "a"), (8, [2.0, 0.0], None, None), (9, [1.0, 0.0], 0, "a"),
        (10, [-1.0, 0.0], 0, "a"), (11, [1.0, 0.0, 0.0], 0, "a"), (12, [5.0, 0.0, 0.0], 0, "a"),
        (None, [1.0, 0.0], 0, "a"), (13, [1e-300, 0.0], 0, "a"),
    ]
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.near_vectors(vectors(spark, rows, "array<double>")).collect()}
    assert len(found) == len(rows)
    for alone in (1, 2, 3, 4, 5, 6, 10):
        assert found[alone] == (0, alone, True)
    for i in (7, 8, 9, 13):
        assert found[i] == (3, 7, i == 7)
    assert found[11] == (1, 11, True) and found[12] == (1, 11, False)
    assert found[None] == (0, None, False)
    assert neighbours.near_vectors(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("dims", [8, 64])
def test_no_link_is_lost_between_hundreds_of_cells(spark, dims):
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(2400, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    # Partners at cosines just above and just below the threshold.
    for i in range(1200, 2400):
        base = x[rng.integers(0, 1200)]
        side = rng.normal(size=dims)
        side -= (side @ base) * base
        cosine = rng.choice([0.9499, 0.9501, 0.951, 0.96, 0.99])
        x[i] = cosine * base + np.sqrt(1 - cosine**2) * side / np.linalg.norm(side)
    rows = [(int(i), [float(v) for v in r * rng.uniform(0.1, 9)], 0, "x") for i, r in enumerate(x)]
    frame = vectors(spark, rows, "array<double>").repartition(4)
    found = neighbours.near_vectors(frame, cell_rows=8, block_rows=256).toPandas().sort_values("vec_id")
    n, label = exact(np.arange(len(x)), x, 0.95)
    assert n.sum() > 1000
    assert (found.n_links.to_numpy() == n).all() and (found.component_id.to_numpy() == label).all()


def test_a_vector_is_not_written_for_each_cell_it_visits(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(1200, 64))
    frame = vectors(spark, [(i, [float(v) for v in r], 0, "x") for i, r in enumerate(x)], "array<double>").repartition(4)
    written, write = {}, neighbours.materialize

    def record(df, name):
        written[name] = (rows := write(df, name)).count()
        return rows

    monkeypatch.setattr(neighbours, "materialize", record)
    # 150 cells, of which a vector visits a third.
    neighbours.near_vectors(frame, cell_rows=8, block_rows=256).collect()
    assert max(written.values()) == 1200


def test_links_of_a_dense_block_are_folded_over_its_strips(monkeypatch):
    n = 400
    x = np.random.default_rng(4).normal(size=(n, 8)) * 0.01 + 1
    side = {"rep": range(n), "copies": [1] * n, "home": [0] * n, "cells": [[0]] * n, "vector": x.tolist()}
    group = pa.concat_tables(pa.table({"side": [s] * n, **side}) for s in (0, 1))
    monkeypatch.setattr(neighbours, "PAIRS", 4 * n)  # four visitors a strip
    found = neighbours._compare(1, 0.95)(group).to_pandas()
    assert (found.groupby("node").n.sum() == n - 1).all() and found.node.nunique() == n
    # Counts come once, and each label gives way to the least one a few times at most.
    assert len(found) < 6 * n
    links = found[found.node != found.label]
    assert set(links.node) == set(range(1, n)) and (links.label < links.node).all()


def test_vectors_of_one_id_stay_apart(spark):
    rows = [
        (1, [1.0, 0.0]), (1, [0.0, 1.0]), (4, [1.0, 0.01]), (4, [1.0, 0.0]), (6, [-1.0, 0.0]), (6, [-1.0, 0.0]),
        (9, [0.7, 0.7]), (9, [0.0, -1.0]), (2, [0.01, -1.0]),
    ]
    for parts in (1, 3):
        frame = vectors(spark, [(*r, 0, "x") for r in rows], "array<double>").repartition(parts)
        found = sorted((r.vec_id, r.n_links, r.component_id) for r in neighbours.near_vectors(frame).collect())
        assert found == [
            (1, 0, 1), (1, 2, 1), (2, 1, 2), (4, 2, 1), (4, 2, 1), (6, 1, 6), (6, 1, 6), (9, 0, 9), (9, 1, 2),
        ]


def test_neighbours_query_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas().sort_values("vec_id")
    x = np.stack(frame.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n, _ = exact(frame.vec_id.to_numpy(), x, 0.95)
    found = queries.op9_neighbours(spark, sf_dir).toPandas().sort_values("vec_id")
    assert len(found) == len(x) and (found.n_links.to_numpy() <= n).all()
    assert found.n_links.sum() >= 0.9 * n.sum()


def test_pages_of_the_table(spark, sf_dir):
    found = queries.op8_pages(spark, sf_dir).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(found) == len(source)
    import html

    for r in found:
        inner = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_pages_of_unseen_layouts():
    trees, rng, right, total = pages.default_trees(), random.Random(1234), 0, 0
    for _ in range(150):
        whole, pieces = pages.training_page(rng)
        marked = "".join(re.sub(r"(?<=>)(?=[^<\s])", "\u0001", p) if g else p for p, g in pieces)
        plain, labelled = pages.Page(whole), pages.Page(marked)
        kept = pages.decode(plain, trees.margin(pages.block_features(plain)))
        truth = ["\u0001" in t for t in labelled.texts]
        right += sum(a == b for a, b in zip(kept, truth))
        total += len(truth)
    assert right / total > 0.98


def test_a_dropped_subtree_keeps_nothing_below():
    page = pages.Page("<div><p>aa</p><div><p>bb</p><p>cc</p></div></div>")
    margin = np.array([0.0, -9.0, -9.0, -9.0, 0.4, -9.0])[: len(page.tags)]
    assert pages.decode(page, margin) == [False, False, False]


def test_page_edges(spark):
    sources = [
        None, "", "plain words", "<p>", "<!-- open", "<script>var a='<p>no</p>'", "a < b &amp; c &#233; &nbsp;x",
        "<article><p>" + "long words here. " * 20000 + "</p></article>", "<p title='a>b'>kept text, in a page.</p>",
        "</div></p>", "<div " * 2000, "<div>" * 3000 + "deep",
    ]
    rows = [(i, None, s, "old") for i, s in enumerate(sources)] + [(None, "u", sources[7], None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = pages.extract_pages(df)
    assert sorted(found.columns) == sorted(df.columns)
    got = {r.page_id: r.text for r in found.collect()}
    assert len(got) == len(rows) and all(t is not None for t in got.values())
    assert got[0] == got[1] == got[3] == got[4] == got[5] == ""
    assert got[7] == got[None] == ("long words here. " * 20000).strip()
    assert pages.extract_pages(df.limit(0)).count() == 0


def test_page_blocks():
    page = pages.Page("<body><p>a&amp;b <b>c<br>d<p>e\n\n f</b><ul><li>g<li>h</ul>i<form>no</form><title>no</title>")
    assert page.texts == ["a&b c d", "e f", "g", "h", "i"]


def test_licences(spark, edge, nothing):
    mit = next(t for n, k, t in licences.TEMPLATES if n == "MIT" and k == "text")
    rows = [
        (1, "Words before.\nReleased under the MIT License.\nWords after it"), (2, mit),
        (3, mit.replace("free of charge", "without any charge")), (4, "intro words\n\n" + mit.replace(". ", ".\n") + "\n\nmore"),
        (5, "released the under license mit"), (6, None), (7, ""), (8, "Licensed under CC BY-NC 4.0."),
        (9, "x " * 50_000 + "\nLicensed under the Apache License, Version 2.0.\n" * 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in licences.licence_report(docs).collect()}
    assert [found[i].licences for i in range(1, 10)] == ["MIT", "MIT", "MIT", "MIT", "", "", "", "CC-BY-NC-4.0", "Apache-2.0"]
    assert found[2].score == 1.0 and 0.8 <= found[3].score < 1
    assert licences.scan_licences(edge).count() == edge.count()
    assert licences.licence_report(nothing).count() == 0


def plain_words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [(m[0], m.start(), m.end()) for m in re.finditer("[0-9a-z\x80-\U0010ffff]+", folded)]


def plain_windows(text, templates, threshold=0.8):
    """Best Dice of each licence over every window of words."""
    grams = [w[0] for w in plain_words(text)]
    grams = list(zip(grams, grams[1:]))
    best = {}
    for name, other in templates:
        for a in range(len(grams)):
            mine = set()
            for g in grams[a:]:
                mine.add(g)
                if len(mine) > 2 * len(other):
                    break
                score = 2 * len(mine & other) / (len(mine) + len(other))
                if score >= threshold:
                    best[name] = max(best.get(name, 0), score)
    return best


def template_grams(templates):
    found = []
    for name, _, text in templates:
        w = [x[0] for x in plain_words(text)]
        found.append((name, set(zip(w, w[1:]))))
    return found


def test_licences_inside_texts(spark):
    def text_of(licence, kind):
        return next(t for n, k, t in licences.TEMPLATES if n == licence and k == kind)

    mit, gpl = text_of("MIT", "text"), text_of("GPL-3.0", "full text")
    cut = mit.index("The above"), mit.index("THE SOFTWARE IS")
    parts = [mit[: cut[0]], mit[cut[0] : cut[1]], mit[cut[1] :]]
    apache = text_of("Apache-2.0", "text").replace(" You may obtain", "\n\nYou may obtain").replace(" Unless", "\n\nUnless")
    long = "some words of a longer document, number %d, that is no licence. "
    around = ["".join(long % (i * k) for i in range(200)) for k in (1, 3)]
    rows = [
        (1, around[0] + "\n\n" + "\n\n".join(parts) + "\n\n" + around[1], "MIT"),
        (2, around[0] + "\n\n" + apache + "\n\n" + around[1], "Apache-2.0"),
        (3, "This project is released under the MIT License. See LICENSE.", "MIT"),
        (4, "before\r\n\r\n" + mit.replace(". ", ".\r\n") + "\r\n\r\nafter it", "MIT"),
        (5, "before\n \t\n" + mit.replace(". ", ".\n") + "\n  \nafter it", "MIT"),
        (6, around[0] + gpl + around[1], "GPL-3.0"),
        (7, (gpl[:9_000] + " changed here and there " + gpl[10_000:]) * 5, "GPL-3.0"),
        (8, around[0] * 20 + "under the mit word and then " + around[1] + " released license", ""),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    found = {r.doc_id: r.licences for r in licences.scan_licences(docs).collect()}
    for key, _, name in rows:
        assert name in [m.licence for m in found[key]] if name else found[key] == [], key
    assert found[1][0].score == 1.0 and found[1][0].segment == "window" and found[6][0].score == 1.0
    assert found[2][0].score == 1.0 and found[3][0].score == 1.0 and found[7][0].score > 0.8
    # Paragraphs, and so wider than the equal windows in them.
    assert [found[k][0].segment for k in (4, 5)] == ["paragraph"] * 2


def test_licence_windows_equal_brute_force(spark):
    rng = random.Random(11)
    short = tuple(t for t in licences.TEMPLATES if t[1] == "notice" or t[0] in ("MPL-2.0", "CC-BY-4.0", "ISC") and t[1] == "text")
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(1, 4)):
            w = [x[0] for x in plain_words(rng.choice(short)[2])]
            for _ in range(rng.randint(0, max(1, len(w) // 5))):
                k = rng.randrange(len(w))
                w[k : k + 1] = rng.choice([[], ["x"], ["x", "y", "x", "y", "x"], [w[k], "the", w[k]], w[:3]])
            words += w + [rng.choice("abx") for _ in range(rng.choice([0, 1, 8]))]
        texts.append("".join(w + rng.choice([" ", " ", " ", ", ", "\n", "\r\n\r\n"]) for w in words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    templates, matched = template_grams(short), 0
    for r in licences.scan_licences(docs, templates=short).collect():
        want = plain_windows(r.text, templates)
        assert {m.licence: m.score for m in r.licences} == want, r.text
        for m in r.licences:
            inside = plain_windows(r.text.encode()[m.start : m.end].decode(), [t for t in templates if t[0] == m.licence])
            assert inside[m.licence] == m.score
        matched += len(want)
    assert matched > 100


def test_licences_equal_plain_dice(spark, documents, sf_dir):
    word = re.compile("[0-9a-z\x80-\U0010ffff]+")

    def grams(text):
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return set(zip(w, w[1:]))

    templates = [(n, grams(t)) for n, _, t in licences.TEMPLATES]
    want = {}
    for r in documents.collect():
        text = r.text or ""
        best = {}
        for segment in [text, *text.split("\n\n"), *text.split("\n")]:
            a = grams(segment)
            for n, b in templates:
                score = 2 * len(a & b) / (len(a) + len(b))
                if score >= 0.8:
                    best[n] = max(best.get(n, 0), score)
        want[r.doc_id] = best
    rows = queries.op6_licences(spark, sf_dir).collect()
    assert {r.doc_id: sorted(filter(None, r.licences.split(","))) for r in rows} == {k: sorted(v) for k, v in want.items()}
    assert all(r.score == max(want[r.doc_id].values(), default=0.0) for r in rows)

import random
import time

import numpy as np
import pandas as pd
import pytest
from brute import components, jaccard_components
from pyspark.sql import functions as F

from spanloom.llm import jaccard, queries
from spanloom.llm.common import CLEAN_UP, materialize
from spanloom.llm.common import components as spark_components


def check(docs, result):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id is not None]
    sizes, parts = jaccard_components(rows)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in result.collect() if r.doc_id is not None}
    assert found == {k: (sizes[k], parts[k]) for k in sizes}


@pytest.mark.parametrize("source", ["edge", "documents"])
def test_equals_brute_force(request, source):
    docs = request.getfixturevalue(source)
    check(docs, jaccard.near_duplicates(docs))


def test_blocks_of_a_large_part_change_nothing(spark):
    rng = random.Random(6)
    base = ["w%d" % rng.randrange(900) for _ in range(80)]
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(6)):
            w[rng.randrange(80)] = "x%d" % rng.randrange(10**6)
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(docs, jaccard.near_duplicates(docs, block_sets=16))


def test_null_id_and_empty_table(edge, nothing):
    row = jaccard.near_duplicates(edge).where("doc_id is null").first()
    assert row.component_id is None and row.n_shingles > 0
    assert jaccard.near_duplicates(nothing).count() == 0


def test_keep_one(documents):
    kept = {r.doc_id for r in jaccard.keep_one(documents).select("doc_id").collect()}
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert kept == {k for k, c in jaccard_components(rows)[1].items() if k == c}


def repeated_ids():
    rng = random.Random(12)
    a, b = (" ".join("w%d" % rng.randrange(10**6) for _ in range(60)) for _ in range(2))
    near, bridge = b.split(), a.split()
    near[30], bridge[59] = "changed", "other"
    return [
        (1, a), (5, a), (1, b), (9, " ".join(near)), (1, a), (None, b), (None, a), (5, "alone here"), (3, "alone here"),
        (7, None), (7, ""), (None, None), (8, " ".join(bridge)),
    ]


@pytest.mark.parametrize("parts", [1, 2, 5])
def test_texts_of_one_id_stay_apart(spark, parts):
    rows = repeated_ids()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    # Plain version: rows are documents, named by their place.
    names = jaccard_components(list(enumerate(t for _, t in rows)))[1]
    least = {}
    for k, c in names.items():
        if rows[k][0] is not None:
            least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    want = sorted((str(rows[k][0]), None if rows[k][0] is None else least[c]) for k, c in names.items())
    found = jaccard.near_duplicates(docs).collect()
    assert sorted(((str(r.doc_id), r.component_id) for r in found), key=str) == sorted(want, key=str)
    kept = sorted((str(r.doc_id), r.text) for r in jaccard.keep_one(docs).collect() if r.text)
    assert kept == sorted([("1", rows[0][1]), ("1", rows[2][1]), ("3", "alone here")])
    assert jaccard.keep_one(docs).columns == docs.columns


def test_keep_one_of_text_ids_and_of_none(spark):
    text = "one two three four five six seven"
    rows = [("b", text, "x"), ("a", text, "y"), (None, text, "z"), (None, "one of its own", "z"), ("c", "", "q")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, __row string")
    kept = jaccard.keep_one(docs)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
    nameless = docs.where("doc_id is null").unionAll(docs.where("doc_id is null"))
    assert sorted(r.text for r in jaccard.keep_one(nameless).collect()) == ["one of its own", text]


def test_registered_query(spark, sf_dir, documents):
    check(documents, queries.op5_jaccard(spark, sf_dir))


def test_trie_finds_every_link():
    rng = np.random.default_rng(8)
    for _ in range(20):
        sets = [np.unique(rng.integers(0, 40, rng.integers(5, 30))) for _ in range(40)]
        part = pd.DataFrame(
            {
                "part": 0, "side": 0, "rep": range(40), "size": [len(s) for s in sets],
                "shared": [s.astype(np.uint64).tobytes() for s in sets],
            }
        )
        want = [
            (a, b) for a in range(40) for b in range(a)
            if 7 * len(np.intersect1d(sets[a], sets[b])) >= 3 * (len(sets[a]) + len(sets[b]))
        ]
        assert components(range(40), jaccard._join_part(part)) == components(range(40), want)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(10, 60)] + [(3, 3), (5, 4), (4, 5)]
    df = spark.createDataFrame(edges, "src long, dst long")
    found = {r.node: r.component for r in spark_components(df).collect()}
    want = components({n for e in edges for n in e}, edges)
    assert {n: c for n, c in want.items() if n != 3} == found
    none = spark.createDataFrame([], "src long, dst long")
    assert spark_components(none).count() == 0


def test_sets_are_not_shuffled_to_leave_out_copies(spark, monkeypatch):
    """Where the classes are too many to be broadcast, the few copies still are."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(12)) for _ in range(600)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:5], *texts])]
    rows = rows[: len(texts) + 5] + [(i, t + " tail of a near copy") for i, t in rows[len(texts) + 5 :]]
    plans = {}

    def spied(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, name)

    monkeypatch.setattr(jaccard, "materialize", spied)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4KB")
    try:
        found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == jaccard_components(rows)[1]
    assert "Exchange hashpartitioning" not in plans["reps"] and "LeftAnti" in plans["reps"]


def test_a_written_table_leaves_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString(" ").split() if "/shuffle_" in f}

    before = shuffled()
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.collect_list("id").alias("ids"))
    written = materialize(rows, "tidy")
    # Removed in the background.
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    # Frames that were written can be used again.
    assert written.agg(F.sum(F.size("ids")).alias("n")).first().n == 5000
    assert materialize(rows, "again").count() == rows.count() == 700
    assert spark.conf.get(CLEAN_UP) == "false"

import corpus_pipeline
from brute import contamination, jaccard_components
from pyspark.sql import functions as F

from spanloom.llm import mixing, quality
from spanloom.llm.common import materialize, table


def test_stages_equal_plain_versions(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, items = docs.columns, [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    good = {r.doc_id for r in quality.score_documents(docs, model).where("score >= 0.3").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        plan = mixing.plan_mix(docs).collect() if k == 3 else None
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}")
        after = sorted(r.doc_id for r in docs.select("doc_id").collect())
        if k < 4:
            assert docs.columns == columns, name
        if k == 0:
            assert after == sorted(good)
        elif k == 1:
            assert after == sorted(i for i, c in jaccard_components(before)[1].items() if i == c)
        elif k == 2:
            assert after == sorted(i for i, v in contamination(before, items).items() if not v[1])
        elif k == 3:
            assert after == sorted(r.doc_id for r in plan for _ in range(r.copies))
        else:
            assert after == sorted(i for i, _ in before)
            slots = docs.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d"))
            assert all(r.n == r.d == r.m + 1 for r in slots.collect())


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination",
        "mixing sources to target weights", "sharding",
    ]

import collections
import re

import duckdb
import pytest
from brute import WORD, contamination
from pyspark.sql import functions as F

from spanloom.llm import decontaminate, mixing, oracles, queries, sharding


def test_contamination_equals_brute_force(spark, edge):
    base = next(r.text for r in edge.where("doc_id = 5").collect())
    items = [(1, " ".join(base.split()[20:45]).upper()), (22, "Two, words!"), (3, None), (4, ""), (9, "--"), (1, "one"),
             (5, " ".join(base.split()[30:41]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want = contamination(rows, items)
    for limit in (1_000_000, 0):
        found = decontaminate.find_contamination(edge, bench, broadcast_windows=limit).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == want
        assert all(r.contaminated == (r.n_hit > 0) for r in found)
    kept = decontaminate.remove_contaminated(edge, bench)
    assert kept.columns == edge.columns
    assert kept.count() == sum(1 for v in want.values() if not v[1])


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_rows_of_one_id_are_judged_one_by_one(spark, limit):
    item = "a b c d e f g h i j k l"
    items = [(1, item), (2, "b c d e f g h i j k"), (3, "short one")]
    rows = [
        (1, item), (1, item), (2, "x x " + item), (2, "a b short one short one " + item), (2, None), (None, item),
        (None, "clean"), (3, "a b c d e f g h i"),
    ]
    want = collections.defaultdict(lambda: (0, 0, set()))
    for k, (n, hit, found) in contamination([(k, t) for k, (_, t) in enumerate(rows)], items).items():
        old = want[rows[k][0]]
        want[rows[k][0]] = (old[0] + n, old[1] + hit, old[2] | set(found))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for parts in (1, 4):
        found = decontaminate.find_contamination(docs.repartition(parts), bench, broadcast_windows=limit).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == {
            k: (n, h, sorted(i)) for k, (n, h, i) in want.items()
        }


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_windows_shorter_than_a_head_are_found_to_the_last_word(spark, limit):
    items = [(1, "a"), (2, "b c"), (3, "D e F"), (4, "d e f g"), (5, "d e x"), (6, "h i j k l m n o p q r s")]
    texts = [
        "z A", "a", "z b c", "b z c", "z d e f", "z d e f g", "d e", "z h i j", "z h i j k l m n o p q", "i j k l m n o p q r, s!",
        "b", "z", "d e f g d e x b c a",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs, bench, broadcast_windows=limit).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == contamination(list(enumerate(texts)), items)


def test_places_are_sifted_before_their_windows_are_cut(spark, documents, sf_dir):
    windows = decontaminate.benchmark_windows(spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10, "item_id", "text")
    hits = decontaminate.window_hits(documents, windows, text="text", doc_id="doc_id", small=True)
    assert hits.collect()
    plan = hits._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    cut, sifted, made = (plan.index(step) for step in ("slice(__w", "LeftSemi", "Generate explode(sequence"))
    # From the last step upwards. All of it runs in generated code, which does not copy the text for each place.
    assert cut < sifted < made and "transform(" not in plan
    assert re.search(r"\*\(\d+\) Generate explode\(sequence", plan)


def test_contamination_of_nothing(spark, edge, nothing):
    bench = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    assert decontaminate.find_contamination(nothing, bench).count() == 0
    assert decontaminate.find_contamination(edge, bench.limit(0)).where("contaminated").count() == 0


def test_contamination_plan_is_native(spark, documents):
    bench = spark.createDataFrame([(1, "some words here")], "item_id long, text string")
    plan = decontaminate.find_contamination(documents, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op10_mixing", "op3_decontaminate"])
def test_registered_queries_equal_sql(spark, sf_dir, name):
    engine = duckdb.connect()
    for t in ("documents", "benchmark"):
        engine.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cursor = engine.execute(oracles.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    found = queries.QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(cursor.fetchall())


def check_shards(rows, shards, biggest):
    total = sum(r.size for r in rows)
    sums, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        sums[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sums) <= set(range(shards))
    assert max(sums.values()) <= total / shards * 1.2 + biggest
    return sums


def test_sharding_query(spark, sf_dir, documents):
    rows = queries.op7_sharding(spark, sf_dir).collect()
    want = {
        r.doc_id: (r.size, r.crc)
        for r in documents.select(
            "doc_id", (F.octet_length("text") + 16).alias("size"), F.crc32("text").alias("crc")
        ).collect()
    }
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == want
    check_shards(rows, 40, max(r.size for r in rows))
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    again = queries.op7_sharding(spark, sf_dir).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_sharding_edges(edge, nothing):
    found = sharding.shard_documents(edge, 4)
    assert sorted(found.columns) == sorted({*edge.columns, "shard", "slot"})
    rows = found.select("shard", "slot", (F.octet_length(F.coalesce("text", F.lit(""))) + 16).alias("size")).collect()
    assert len(rows) == edge.count()
    check_shards(rows, 4, max(r.size for r in rows))
    assert sharding.shard_documents(nothing, 4).count() == 0


def test_sharding_splits_hot_groups_and_keeps_small_ones(spark):
    rows = [(i, "hot text " * 30 if i % 3 == 0 else f"text {i // 6} " * 30) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sharding.shard_documents(docs, 8)
    rows = found.select("doc_id", "text", "shard", "slot", (F.octet_length("text") + 16).alias("size")).collect()
    sums = check_shards(rows, 8, 400)
    assert min(sums.values()) > 0.9 * sum(sums.values()) / 8
    spread = collections.defaultdict(set)
    for r in rows:
        spread[r.text].add(r.shard)
    assert all(len(s) == 1 for t, s in spread.items() if not t.startswith("hot"))
    assert 3 <= len(spread["hot text " * 30]) <= 4


def test_repeated_rows_are_sharded_one_by_one(spark):
    docs = spark.createDataFrame([(1, "same")] * 500, "doc_id long, text string")
    rows = sharding.shard_documents(docs, 5).collect()
    check_shards([type("R", (), dict(size=20, shard=r.shard, slot=r.slot)) for r in rows], 5, 20)
    assert len(rows) == 500


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 90)], "source string, size long")
    rows = {r.source: r for r in mixing.source_targets(sizes, (5, 2, 1), 3).collect()}
    total = 1600
    assert rows["a"].target == 30
    # 5 : 2 : 1 over a, b, c and 5 again for null, which is capped too.
    assert rows[None].target == 270
    assert rows["b"].target == pytest.approx((total - 300) * 2 / 3)
    assert rows["c"].target == pytest.approx((total - 300) / 3)


def test_mix_of_edges(edge, nothing):
    rows = mixing.plan_mix(edge).collect()
    sizes = sorted(len(WORD.findall(r.text or "")) for r in edge.collect())
    assert sorted(r["size"] for r in rows) == sizes
    assert all(0 <= r.copies <= 3 and (r.copies == 0 or r["size"] > 0) for r in rows)
    mixed = mixing.mix_documents(edge, shards=3)
    assert sorted(mixed.columns) == sorted({*edge.columns, "shard", "order_key"})
    assert mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix_documents(nothing).count() == 0


def test_mix_draws_blocks_evenly_and_again(spark, documents):
    plan = mixing.plan_mix(documents)
    draws = mixing.draw_mix(plan, shards=5)
    first = sorted(map(tuple, draws.select("doc_id", "__copy", "shard", "order_key").collect()))
    units = draws.select("__s", "__block", "__copy", "shard").distinct().groupBy("shard").count().collect()
    assert len(units) == 5 and max(u["count"] for u in units) - min(u["count"] for u in units) <= 5
    again = mixing.draw_mix(mixing.plan_mix(documents.repartition(3)), shards=5)
    assert first == sorted(map(tuple, again.select("doc_id", "__copy", "shard", "order_key").collect()))


def test_repeated_rows_mix_one_by_one(spark):
    docs = spark.createDataFrame([(1, "one two", "a")] * 40 + [(2, "three four", "b")] * 40, "doc_id long, text string, source string")
    plan = mixing.plan_mix(docs).collect()
    assert len(plan) == 80
    assert mixing.mix_documents(docs).count() == sum(r.copies for r in plan)


@pytest.mark.parametrize("small", [True, False])
def test_a_place_takes_only_its_own_words_along(edge, spark, small):
    items = spark.createDataFrame([("1", "one two three four")], "item_id string, text string")
    windows = decontaminate.benchmark_windows(items, 3, "item_id", "text")
    hits = decontaminate.window_hits(edge, windows, text="text", doc_id="doc_id", small=small)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    generated = next(line for line in plan.split("\n") if "Generate explode" in line and "__p" in line)
    above = plan[: plan.index(generated)]
    assert "__w#" not in above and "__p" in above

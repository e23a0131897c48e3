import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanloom.functions import sketches as K
from spanloom.operators import guard, rollup
from spanloom.operators.quality import sketch_accuracy
from spanloom.plans import dashboards
from spanloom.session import literal_rows

NOW = datetime(2024, 2, 1)


def test_guard_tells_absent_from_unregistered(spark, tables):
    guarded = guard.guard_dimensions(tables.spans, tables.allowlist, tables.registry)
    before, after = tables.spans.alias("a"), guarded.alias("b")
    models = {
        (r[0], r[1])
        for r in before.join(after, "span_id").select("a.model", "b.model").distinct().collect()
    }
    assert ("", "__none__") in models
    assert ("shadow-deploy-v9", "__other__") in models
    assert all(b in (a, "__none__", "__other__") for a, b in models)
    assert guarded.count() == tables.spans.count()
    assert guarded.columns == tables.spans.columns


def test_guard_with_an_empty_allowlist(spark, tables):
    nothing = tables.allowlist.limit(0)
    guarded = guard.guard_dimensions(tables.spans, nothing, tables.registry)
    assert {r[0] for r in guarded.select("tenant_id").distinct().collect()} == {"__other__"}
    assert {r[0] for r in guarded.select("model").distinct().collect()} == {
        "__other__",
        "__none__",
    }


def test_top_k_breaks_ties_by_value_and_respects_its_window(spark, tables):
    rows = [(v, NOW - timedelta(hours=h)) for v in "cba" for h in (1, 2)]
    rows += [("old", NOW - timedelta(hours=30))] * 9 + [("", NOW - timedelta(hours=1))] * 9
    rows += [("later", NOW + timedelta(hours=1))] * 9
    spans = spark.createDataFrame(rows, "tenant_id string, ts timestamp")
    registry = tables.registry.with_dimension("tenant_id", budget=2, top_k_window_hours=24)
    found = guard.top_k_values(spans, registry, NOW).collect()
    assert [(r["value"], r["spans"]) for r in found] == [("a", 2), ("b", 2)]


def test_dimensions_stay_within_budget(spark, tables):
    registry = tables.registry.with_dimension("tenant_id", budget=5)
    allowlist = guard.build_allowlist(tables.spans, registry, NOW)
    states = rollup.rollup_1m(tables.spans, allowlist, registry)
    rows = guard.cardinality_status(states, allowlist, registry).collect()
    assert len(rows) == 7 and all(r["within_budget"] for r in rows)
    tenant = next(r for r in rows if r["dimension"] == "tenant_id")
    assert (tenant["observed_distinct"], tenant["allowlisted"], tenant["headroom"]) == (6, 5, 0)
    worst = dashboards.worst_minute(states, registry).first()
    assert 0 < worst["value"] <= worst["bound"] == registry.max_rows_per_bucket


def test_rollup_totals_equal_raw_and_hours_equal_minutes(spark, tables):
    raw = tables.spans.agg(
        F.count("*"), F.sum("input_tokens"), F.sum("output_tokens"),
        F.count_if(F.col("status_class") != "ok"),
    ).first()
    for states in (tables.minute, tables.hour):
        got = rollup.finalize(states).first()
        assert (got["spans"], got["input_tokens"], got["output_tokens"], got["errors"]) == raw


def test_an_empty_status_is_an_error_and_an_unlisted_ok_is_not(spark, tables):
    spans = tables.spans.limit(2).withColumn(
        "status_class", F.when(F.monotonically_increasing_id() == 0, "").otherwise("ok")
    )
    states = rollup.rollup_1m(spans, tables.allowlist.limit(0), tables.registry)
    assert rollup.finalize(states).first()["errors"] == 1


def test_states_merge_alike_in_any_order_and_split(spark, tables):
    parts = tables.spans.randomSplit([0.2, 0.5, 0.3], seed=5)
    states = [rollup.rollup_1m(p, tables.allowlist, tables.registry) for p in parts]
    forward = states[0].unionByName(states[1]).unionByName(states[2])
    backward = states[2].unionByName(states[1]).unionByName(states[0])
    columns = ["spans", "input_tokens", "errors", "ttft_p50", "ttft_p95", "kv_cache_max"]
    whole = rollup.finalize(tables.minute, ["operation"]).select("operation", *columns)
    for df in (forward, backward):
        got = rollup.finalize(df, ["operation"]).select("operation", *columns)
        assert sorted(got.collect()) == sorted(whole.collect())


def test_no_measure_gives_null_not_an_error(spark, tables):
    quiet = tables.spans.withColumn("ttft_ms", F.lit(0.0))
    states = rollup.rollup_1m(quiet, tables.allowlist, tables.registry)
    row = rollup.finalize(states).first()
    assert row["ttft_p95"] is None and row["spans"] == quiet.count()
    nothing = rollup.finalize(states.limit(0)).first()
    assert nothing["spans"] == 0 and nothing["error_rate"] is None


@pytest.mark.parametrize("p", [0.5, 0.95, 0.99])
def test_quantile_sketch_error(spark, p):
    """Log-normal values: within the error of a bucket, so the rank is at most half a percent off."""
    rng = random.Random(11)
    rows = [(rng.lognormvariate(4, 0.8),) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "v double").repartition(8)
    row = sketch_accuracy(df.withColumn("g", F.lit(1)), ["g"], "v", p).first()
    below = sum(v < row["sketched"] for (v,) in rows) / len(rows)
    assert abs(below - p) < 0.005
    assert row["relative_error"] <= K.quantile_error() + 1e-4


def test_distinct_sketch_error(spark):
    df = spark.range(50_000).select(F.concat(F.lit("t"), F.col("id") % 20_000).alias("t"))
    estimate = df.agg(K.read_distinct(K.distinct_state(F.col("t")))).first()[0]
    assert abs(estimate - 20_000) / 20_000 < 0.05


def test_unused_sketches_leave_the_plan(spark, tables):
    plan = dashboards.token_throughput(tables.minute)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "top_k" not in text and "theta" not in text


def test_guard_is_broadcast_without_shuffling_the_spans(spark, tables):
    guarded = guard.guard_dimensions(tables.spans, tables.allowlist, tables.registry)
    text = guarded._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_breakdown_and_unregistered_values_agree(spark, tables):
    breakdown = {r["dimension"]: r for r in guard.bucket_breakdown(
        tables.minute, tables.registry).collect()}
    named = guard.unregistered_values(tables.spans, tables.allowlist, tables.registry, None)
    by_dimension = {r[0]: r[1] for r in named.groupBy("dimension").agg(F.sum("spans")).collect()}
    total = tables.spans.count()
    for name, row in breakdown.items():
        assert row["unregistered"] == by_dimension.get(name, 0)
        assert row["registered"] + row["unregistered"] + row["absent"] == total
    value = dashboards.unregistered_spans(tables.minute, tables.registry).first()["value"]
    assert value == sum(by_dimension.values())


def test_coverage_by_minute_finds_a_gap_that_totals_hide(spark, tables):
    # The rollup still holds old minutes raw has lost, and lacks a recent one.
    spans = tables.spans.filter(F.col("ts") >= F.lit(datetime(2024, 1, 10)))
    gap = (datetime(2024, 1, 20), datetime(2024, 1, 20, 12))
    holed = tables.minute.filter(~F.col("ts_minute").between(*map(F.lit, gap)))
    assert rollup.coverage(spans, holed).first()["missing_spans"] == 0
    found = rollup.coverage_by_minute(spans, holed)
    lost = tables.spans.filter(F.col("ts").between(*map(F.lit, gap))).count()
    assert found.agg(F.sum("missing_spans")).first()[0] == lost > 0


def test_literal_rows_quote_their_text(spark):
    rows = [("it's", 1, 0.5, True), ("back\\slash", 2, -1.0, False), (None, 3, 0.0, True)]
    assert [tuple(r) for r in literal_rows(spark, rows, "a, b, c, d").collect()] == rows

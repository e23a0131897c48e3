from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanloom.operators import guard, heavy
from spanloom.sources.tables import TableStore

AS_OF = datetime(2024, 1, 30)


def test_counts_from_states_equal_raw_counts(spark, tables):
    states = heavy.value_states(tables.spans, tables.registry)
    found = {(r["dimension"], r["value"]): r["spans"] for r in heavy.heavy_values(states).collect()}
    for d in tables.registry.dimensions:
        raw = tables.spans.filter(F.col(d.column) != "").groupBy(d.column).count().collect()
        assert {v: n for (name, v), n in found.items() if name == d.name} == {r[0]: r[1] for r in raw}


def test_few_counters_stay_inside_their_bound(spark, tables):
    """Far more values than are tracked: a count is never too low, and at most the bound too high."""
    rows = [(k % 7 if k % 2 else 7 + k % 3000,) for k in range(60_000)]
    skewed = spark.createDataFrame(rows, "v int").select(
        F.lit(AS_OF).alias("ts"), F.concat(F.lit("t"), F.col("v")).alias("tenant_id"),
        *[F.lit("").alias(c) for c in tables.registry.columns if c != "tenant_id"],
    )
    exact = Counter(f"t{v}" for (v,) in rows)
    parts = [heavy.value_states(p, tables.registry, 48) for p in skewed.randomSplit([0.3, 0.3, 0.4], seed=2)]
    states = parts[0].unionByName(parts[1]).unionByName(parts[2])
    found = heavy.heavy_values(states, 48).collect()
    assert all(r["spans"] - r["bound"] <= exact[r["value"]] <= r["spans"] for r in found)
    listed = {r["value"] for r in found}
    assert {f"t{v}" for v in range(7)} <= listed
    assert max(n for v, n in exact.items() if v not in listed) <= found[0]["bound"]


def test_the_allowlist_from_states_is_that_of_the_raw_spans(spark, tables):
    states = heavy.value_states(tables.spans, tables.registry)
    # Whole minutes, so the window ends where one does.
    inside = tables.spans.filter(F.col("ts") < F.lit(AS_OF))
    raw = guard.top_k_values(inside, tables.registry, AS_OF).collect()
    found = heavy.top_k_from_states(states, tables.registry, AS_OF).select("dimension", "value", "spans").collect()
    assert sorted(found) == sorted(raw)
    with pytest.raises(ValueError, match="larger budget"):
        heavy.top_k_from_states(states, tables.registry, AS_OF, tracked=8)


def test_unregistered_values_from_states(spark, tables):
    states = heavy.value_states(tables.spans, tables.registry)
    raw = guard.unregistered_values(tables.spans, tables.allowlist, tables.registry, 50).collect()
    found = heavy.unregistered_from_states(states, tables.allowlist).select("dimension", "value", "spans").collect()
    assert found == raw
    assert heavy.heavy_values(states.limit(0)).count() == 0


def test_compaction_keeps_the_counts(spark, tables, folder):
    store = TableStore(spark, folder)
    states = heavy.value_states(tables.spans, tables.registry)
    day = datetime(2024, 1, 7)
    for k in (0, 1):
        part = tables.spans.filter(F.pmod(F.xxhash64("span_id"), F.lit(2)) == k)
        store.write(heavy.value_states(part, tables.registry), "values_1m", f"batch-{k}")
    assert store.compact("values_1m", day.date()).startswith("snapshot-")
    back = heavy.heavy_values(store.read("values_1m", day, day + timedelta(days=1))).collect()
    inside = states.filter((F.col("ts_minute") >= F.lit(day)) & (F.col("ts_minute") < F.lit(day + timedelta(days=1))))
    assert sorted(back) == sorted(heavy.heavy_values(inside).collect())


def test_many_values_of_even_shares_are_counted_exactly(spark, tables, folder):
    """More values than are ever listed, all about as frequent: none is lost or counted too high."""
    rows = [(k % 4_000 if k % 5 else k % 40,) for k in range(24_000)]
    even = spark.createDataFrame(rows, "v int").select(
        F.lit(datetime(2024, 1, 29, 12)).alias("ts"), F.concat(F.lit("t"), F.col("v")).alias("tenant_id"),
        *[F.lit("").alias(c) for c in tables.registry.columns if c != "tenant_id"],
    )
    exact = Counter(f"t{v}" for (v,) in rows)
    wanted = sorted(exact.items(), key=lambda e: (-e[1], e[0]))
    store = TableStore(spark, folder)
    for k, part in enumerate(even.randomSplit([0.5, 0.5], seed=3)):
        store.write(heavy.value_states(part, tables.registry), "values_1m", f"batch-{k}")
    states = store.read("values_1m")
    day = tables.registry.with_dimension("tenant_id", budget=30, top_k_window_hours=24)
    found = heavy.top_k_from_states(states, day, AS_OF).collect()
    assert sorted((-r["spans"], r["value"]) for r in found) == [(-n, v) for v, n in wanted[:30]]
    assert {r["bound"] for r in found} == {42}
    assert len(heavy.heavy_values(states).collect()) == heavy.TRACKED
    known = tables.allowlist.limit(0).select("dimension", "value").unionByName(
        spark.createDataFrame([("tenant_id", wanted[0][0])], "dimension string, value string")
    )
    rest = heavy.unregistered_from_states(states, known, None).collect()
    assert [(r["value"], r["spans"]) for r in rest] == wanted[1:]

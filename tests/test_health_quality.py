from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanloom.operators import health, quality
from spanloom.plans import bi, dashboards, live
from spanloom.sources.metrics import read_metrics_dumps

DUMP = """# HELP otelcol_receiver_accepted_spans x
otelcol_receiver_accepted_spans{receiver="a"} 100
otelcol_receiver_accepted_spans{receiver="b"} 20.0
otelcol_exporter_sent_spans_total{exporter="k"} 1.1e2
otelcol_exporter_queue_size 7
otelcol_exporter_queue_capacity not-a-number
unrelated 5
"""


def test_metrics_text(spark, tmp_path):
    (tmp_path / "one.txt").write_text(DUMP)
    (tmp_path / "empty.txt").write_text("# nothing\n")
    rows = health.parse_metrics(read_metrics_dumps(spark, str(tmp_path))).collect()
    assert len(rows) == 1 and rows[0]["scrape"] == "one.txt"
    row = rows[0]
    assert (row["accepted_spans"], row["sent_spans"], row["queue_size"]) == (120, 110, 7)
    assert row["queue_capacity"] == 0 and row["refused_spans"] == 0


def test_lag_counts_everything_without_a_commit(spark):
    high = spark.createDataFrame([(0, 100), (1, 50), (2, 10)], "partition int, high long")
    committed = spark.createDataFrame([(0, 90), (1, -1001), (2, 30)], "partition int, committed long")
    assert tuple(health.consumer_lag(high, committed).first()) == (60, 50, 3)
    nothing = committed.limit(0)
    assert tuple(health.consumer_lag(high, nothing).first()) == (160, 100, 3)


def at(minute):
    return datetime(2024, 1, 1) + timedelta(minutes=minute)


def test_a_failed_scrape_writes_no_row(spark):
    lag = spark.createDataFrame([(at(0), 5, 5, 1), (at(1), 6, 6, 1)],
                                "sampled_at timestamp, total_lag long, max_partition_lag long, "
                                "partitions long")  # fmt: skip
    columns = ", ".join(f"{c} long" for c in health.HEALTH_COUNTERS)
    counters = spark.createDataFrame(
        [(at(0), 1, 2, 3, 4, 5, 6, 7), (at(1), None, 2, 3, 4, 5, 6, 7)],
        f"sampled_at timestamp, {columns}",
    )
    rows = health.health_rows(lag, counters).collect()
    assert [r["sampled_at"] for r in rows] == [at(0)]


def test_counter_growth_has_no_false_spikes(spark):
    values = [50, 60, 60, 5, 25]
    rows = [(at(i * 50), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "sampled_at timestamp, c long").repartition(4)
    grown = health.counter_growth(df, {"c": F.col("c")}).orderBy("time").collect()
    assert [r["c"] for r in grown] == [0, 10, 0, 0, 20]


def test_latest_sample_panels(spark, tables):
    newest = tables.health.orderBy(F.desc("sampled_at")).first()
    assert dashboards.current_lag(tables.health).first()["value"] == newest["total_lag"]
    assert dashboards.export_queue(tables.health).first()["value"] == newest["queue_size"] / 100
    empty = tables.health.withColumn("queue_capacity", F.lit(0).cast("bigint"))
    assert dashboards.export_queue(empty).first()["value"] is None
    assert dashboards.current_lag(tables.health.limit(0)).count() == 0


def test_latency_refuses_backlogs(spark, tables):
    def lag(n):
        return spark.createDataFrame([(n,)], "total_lag long")

    for refused in (lag(501), lag(500).limit(0)):
        with pytest.raises(Exception, match="latency asked for with a lag"):
            quality.latency_stats(tables.spans, refused).collect()
    drained = quality.latency_stats(tables.spans, lag(500)).first()
    assert drained == quality.latency_stats(tables.spans, None).first()


def test_lag_counts_topics_and_streams_apart(spark):
    high = spark.createDataFrame([("a", 0, 100), ("b", 0, 60)], "topic string, partition int, high long")
    read = spark.createDataFrame([("a", 0, 50), ("b", 0, 55)], "topic string, partition int, committed long")
    assert tuple(health.consumer_lag(high, read).first()) == (55, 50, 2)


def test_latency_excludes_the_span_itself(spark, tables):
    exact = quality.latency_stats(tables.spans, None).first()
    sketched = quality.latency_stats(tables.spans, None, exact=False).first()
    assert exact["n"] == sketched["n"] == tables.spans.count()
    # Arrival was set to span end plus a whole number of seconds up to nine.
    assert 0 <= exact["p50_s"] <= 9.001 and exact["max_s"] == pytest.approx(9.0, abs=0.002)
    assert sketched["p95_s"] == pytest.approx(exact["p95_s"], rel=0.01)


def test_rate_needs_a_range_or_a_divisor(spark, tables):
    with pytest.raises(ValueError):
        dashboards.spans_per_second(tables.minute)
    period = (datetime(2024, 1, 1), datetime(2024, 1, 31))
    n = tables.spans.count()
    whole = dashboards.spans_per_second(tables.minute, period).first()["value"]
    assert whole == pytest.approx(n / (30 * 86400))
    assert dashboards.spans_per_second(tables.minute, period, 60).first()["value"] == n / 60


def test_top_tenants_keeps_ties_at_the_border(spark):
    totals = [("a", 9), ("b", 7), ("c", 7), ("d", 5), ("e", 5), ("f", 1)]
    report = spark.createDataFrame(totals, "tenant_id string, tokens long")
    rows = bi.top_tenants(report, top=4).collect()
    assert [(r["tenant_id"], r["rank"]) for r in rows] == [
        ("a", 1), ("b", 2), ("c", 2), ("d", 4), ("e", 4)
    ]
    assert [r["rank"] for r in bi.top_tenants(report, top=3).collect()] == [1, 2, 2]


def test_shares_add_up_to_all_spans(spark, tables):
    rows = live.tenant_shares(tables.minute, tables.registry).collect()
    assert rows[-1]["name"] == "__other__" and len(rows) == 11
    assert sum(r["n"] for r in rows) == tables.spans.count()


def test_tool_calls_have_a_blank_first_token_time(spark, tables):
    report = bi.relabel(tables.spans)
    tools = report.filter(F.col("model") == bi.TOOL_LABEL)
    assert tools.count() > 0 and tools.filter(F.col("ttft_ms").isNotNull()).count() == 0
    agents = tables.spans.filter("operation = 'invoke_agent'").count()
    zero = report.filter("ttft_ms = 0").count()
    assert zero == agents

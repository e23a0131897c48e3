"""Time the headline jobs and queries; prints one JSON line.

Jobs (decode, ingest, export) run once on fresh tables, queries twice with the
better time kept. ``value`` is the sum of all times. Further fields relate the
jobs to their rows: spans per second, bytes per lake row, rows per rollup row.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from registered import queries as registered_queries
from registered.tables import LAST, PERIOD, Tables
from spanloom.operators import decode
from spanloom.operators.rollup import rollup_1m
from spanloom.plans import bi, dashboards, lake
from spanloom.session import build_session
from spanloom.sources import lake as L
from spanloom.sources.messages import load_messages
from spanloom.sources.tables import TableStore
from spanloom.streaming.ingest import ingest_batch

# Registered queries timed from the raw event log, rollup included.
FROM_EVENTS = (
    "d01_cardinality_guard",
    "d02_unregistered_values",
    "e11_exact_quantiles",
    "e11_exact_quantiles_lineitem",
    "g01_minute_rollup",
    "g02_hour_rollup",
    "g10_cardinality_status",
    "g12_latency_stats",
    "g13_source_fingerprint",
    "m09_run_grading",
    "m11_quality_counts",
    "q08_ttft_quantiles",
    "q11_top_tenants",
    "q20_ingest_latency",
    "q21_collector_throughput",
    "q27_bucket_breakdown",
    "q38_report_model_table",
    "q43_rollup_agreement",
    "w01_dedup",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": root,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, sf_dir)
    times: dict[str, float] = {}

    def once(name: str, action):
        began = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - began, 3)
        return result

    def best(name: str, plan, runs: int = 2) -> None:
        took = []
        for _ in range(runs):
            began = time.perf_counter()
            plan().write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        times[name] = round(min(took), 3)

    # Inputs of the jobs, not timed.
    messages = load_messages(spark, tables.message_files)
    tables.spans.agg(F.count("*")).collect()

    best("job_decode", lambda: decode.decode_spans(messages, LAST))
    store = TableStore(spark, f"{root}/hot")
    once("job_allowlist", lambda: store.publish_allowlist(tables.allowlist, tables.registry))
    # Two blocks of the stream: the first warms up, the second is fresh rows at a steady pace.
    blocks = [messages.filter(F.col("offset") % 2 == part) for part in (0, 1)]
    once("job_ingest_first", lambda: ingest_batch(blocks[0], 0, store, tables.registry))
    early = store.read("spans_raw").count()
    once("job_ingest_steady", lambda: ingest_batch(blocks[1], 1, store, tables.registry))
    # From the arrival of a block to an answer over its states.
    began = time.perf_counter()
    ingest_batch(blocks[1], 1, store, tables.registry)
    store.read("spans_1m").agg(F.sum("spans")).collect()
    queryable = time.perf_counter() - began
    raw, minute, hour = (store.read(t) for t in ("spans_raw", "spans_1m", "spans_1h"))
    spans = raw.count()
    state_rows, hour_rows = minute.count(), hour.count()
    # The month's events within one hour: as dense as a live stream.
    first = F.lit(PERIOD[0].timestamp())
    dense = tables.spans.withColumn(
        "ts", F.timestamp_seconds(first + (F.unix_micros("ts") / 1e6 - first) / (24 * 31))
    )
    dense_rows = rollup_1m(dense, tables.allowlist, tables.registry).count()
    exported = once(
        "job_lake_export",
        lambda: L.run_export(
            raw, f"{root}/lake", now=LAST + timedelta(minutes=5), window=timedelta(days=1)
        ),
    )
    stats = L.lake_stats(spark, f"{root}/lake").first()
    stored = L.lake_scan(spark, f"{root}/lake")

    one_day = (datetime(2024, 1, 15), datetime(2024, 1, 16))
    best("stored_q07_token_throughput", lambda: dashboards.token_throughput(minute, PERIOD))
    best("stored_q08_ttft_quantiles", lambda: dashboards.time_to_first_token(minute, PERIOD))
    best("stored_q08_one_day", lambda: dashboards.time_to_first_token(minute, one_day))
    best("stored_q11_top_tenants", lambda: dashboards.top_tenants(minute, PERIOD))
    best("stored_q11_hours", lambda: dashboards.top_tenants(
        hour.withColumnRenamed("ts_hour", "ts_minute"), PERIOD))
    best("stored_q22_unregistered", lambda: dashboards.unregistered_spans(
        minute, tables.registry, PERIOD))
    best("lake_tenant_query", lambda: stored.filter(F.col("tenant_id") == "tenant-0007").agg(
        F.count("*"), F.sum("output_tokens")))
    best("lake_full_scan", lambda: stored.agg(F.count("*"), F.sum("output_tokens"),
                                              F.avg("ttft_ms")))
    best("lake_q32_top_tenants", lambda: lake.top_tenants_by_tokens(stored))
    best("lake_q33_daily_volume", lambda: lake.daily_volume(stored))
    best("lake_q34_model_latency", lambda: lake.model_latency_by_hour(stored))
    best("lake_q35_report_cards", lambda: bi.cards(bi.relabel(stored)))
    best("lake_sort_check", lambda: L.sort_violations(stored))

    queries = registered_queries.queries()
    for name in FROM_EVENTS:
        best(name, lambda name=name: queries[name](spark, sf_dir))

    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "spans": spans,
                "decode_spans_per_sec": round(spans / times["job_decode"]),
                "ingest_spans_per_sec": round((spans - early) / times["job_ingest_steady"]),
                "block_to_queryable_sec": round(queryable, 3),
                "dense_rows_per_minute_row": round(spans / dense_rows, 2),
                "raw_rows_per_minute_row": round(spans / state_rows, 2),
                "raw_rows_per_hour_row": round(spans / hour_rows, 2),
                "lake_rows": exported.agg(F.sum("stored_rows")).first()[0],
                "lake_bytes_per_row": round(stats["bytes_per_row"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

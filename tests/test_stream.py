import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from registered.queries import queries
from registered.tables import Tables
from spanloom.operators.backfill import backfill, backfill_window
from spanloom.operators.decode import dead_letters, decode_spans
from spanloom.operators.health import METRIC_PREFIXES
from spanloom.operators.rollup import finalize
from spanloom.sources.messages import load_messages, read_message_files
from spanloom.sources.tables import TableStore
from spanloom.streaming.ingest import (
    complete_windows,
    ingest_batch,
    once_per_span,
    start_ingest,
    windowed_states,
)
from spanloom.streaming.monitor import (
    ProgressLog,
    expire_progress,
    health_pass,
    lag_samples,
    record_health,
)

NOW = datetime(2024, 2, 1)
FIGURES = ("spans", "input_tokens", "output_tokens", "errors")


def totals(states):
    return tuple(finalize(states).select(*FIGURES).first())


def raw_totals(spans):
    return tuple(
        spans.agg(
            F.count("*"),
            F.sum("input_tokens"),
            F.sum("output_tokens"),
            F.count_if(F.col("status_class") != "ok"),
        ).first()
    )


def test_stream_equals_batch(spark, tables):
    store = tables.store
    batch = decode_spans(load_messages(spark, tables.message_files), NOW)
    assert raw_totals(store.read("spans_raw")) == raw_totals(batch)
    assert totals(store.read("spans_1m")) == totals(store.read("spans_1h")) == raw_totals(batch)
    assert store.read("spans_1m").select("write_id").distinct().count() > 1


def test_a_replayed_batch_changes_nothing(spark, tables, folder):
    store = TableStore(spark, folder)
    store.publish_allowlist(tables.allowlist, tables.registry)
    messages = load_messages(spark, tables.message_files)
    ingest_batch(messages, 0, store, tables.registry)
    names = ("spans_raw", "spans_1m", "spans_1h", "dead_letters")
    before = {n: store.read(n).count() for n in names}
    ingest_batch(messages, 0, store, tables.registry)
    assert {n: store.read(n).count() for n in names} == before
    ingest_batch(messages, 1, store, tables.registry)
    assert store.read("spans_raw").count() == 2 * before["spans_raw"]


def test_a_bad_message_does_not_stop_the_stream(spark, tables, folder):
    bad = ["{", "", "null", '{"resourceSpans":[{"scopeSpans":[{"spans":["x",{"spanId":"kept"}]}]}]}']
    rows = [(v, "otel.spans", 0, i) for i, v in enumerate(bad)]
    spark.createDataFrame(
        rows, "value string, topic string, partition int, offset long"
    ).write.json(folder + "/in")
    store = TableStore(spark, folder + "/hot")
    query = start_ingest(
        read_message_files(spark, folder + "/in"),
        store,
        tables.registry,
        folder + "/checkpoint",
        {"availableNow": True},
    )
    query.awaitTermination()
    assert query.exception() is None
    assert store.read("dead_letters").count() == 3
    assert store.read("spans_raw").filter("span_id = 'kept'").count() == 1
    # Without an allowlist every present value is unregistered.
    assert finalize(store.read("spans_1m")).first()["spans"] == 2


def test_closed_minutes_of_the_stateful_mode(spark, tables, folder):
    stream = decode_spans(read_message_files(spark, tables.message_files), NOW)
    states = windowed_states(stream, tables.store.read_allowlist(), tables.registry, "1 hour")
    query = (
        states.writeStream.format("memory").queryName("closed").outputMode("append")
        .option("checkpointLocation", folder).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    closed = totals(spark.table("closed"))
    everything = raw_totals(tables.store.read("spans_raw"))
    assert 0 < closed[0] < everything[0]


def test_redelivery_inside_the_watermark_is_dropped(spark, tables, folder):
    tables.redelivered.write.parquet(folder + "/in")
    schema = spark.read.parquet(folder + "/in").schema
    stream = spark.readStream.schema(schema).parquet(folder + "/in")
    query = (
        once_per_span(stream, "40 days").select("span_id").writeStream.format("memory")
        .queryName("once").option("checkpointLocation", folder + "/c")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("once").count() == tables.spans.count()


@pytest.fixture
def store(spark, tables, folder):
    store = TableStore(spark, folder)
    store.publish_allowlist(tables.allowlist, tables.registry)
    spans = tables.spans.withColumn("attributes", F.create_map().cast("map<string,string>"))
    store.write(spans, "spans_raw", "batch-0")
    return store


def test_backfill_is_safe_to_repeat(spark, tables, store):
    start, end = backfill_window(store)
    assert start == datetime(2024, 1, 1, 0, 9)
    assert backfill(store, tables.registry, start, end) == tables.spans.count()
    assert backfill(store, tables.registry, start, end) == tables.spans.count()
    assert totals(store.read("spans_1m")) == raw_totals(tables.spans)
    assert totals(store.read("spans_1h")) == raw_totals(tables.spans)
    assert backfill_window(store) is None
    with pytest.raises(ValueError, match="empty"):
        backfill(store, tables.registry, end, start)


def test_backfill_stops_where_the_rollup_begins(spark, tables, store):
    late = tables.minute.filter(F.col("ts_minute") >= F.lit(datetime(2024, 1, 15)))
    store.write(late, "spans_1m", "batch-0")
    start, end = backfill_window(store)
    backfill(store, tables.registry, start, end)
    assert totals(store.read("spans_1m")) == raw_totals(tables.spans)


def test_compaction_keeps_totals_at_every_step(spark, tables, store):
    day = date(2024, 1, 7)
    chat = F.col("operation") == "chat"
    store.write(tables.minute.filter(chat), "spans_1m", "batch-0")
    store.write(tables.minute.filter(~chat), "spans_1m", "batch-1")
    # A snapshot whose log row was never written does not count.
    store.write(tables.minute.filter(chat), "spans_1m", "snapshot-orphan")
    expected = raw_totals(tables.spans)
    assert totals(store.read("spans_1m")) == expected
    snapshot = store.compact("spans_1m", day)
    assert totals(store.read("spans_1m")) == expected
    on_day = store.read("spans_1m").filter(F.col("dt") == F.lit(day))
    assert [r[0] for r in on_day.select("write_id").distinct().collect()] == [snapshot]
    assert store.vacuum("spans_1m") == 2
    assert totals(store.read("spans_1m")) == expected
    # Rows that arrive later join the snapshot, and both can be compacted again.
    late = tables.minute.filter(F.to_date("ts_minute") == F.lit(day))
    store.write(late, "spans_1m", "batch-2")
    more = totals(store.read("spans_1m"))
    assert more[0] == expected[0] + totals(late)[0]
    assert store.compact("spans_1m", day) != snapshot
    assert totals(store.read("spans_1m")) == more
    assert store.compact("spans_1m", day) is None


def test_a_write_survives_being_compacted(spark, tables, store):
    day = date(2024, 1, 7)
    chat = F.col("operation") == "chat"
    store.write(tables.minute.filter(chat), "spans_1m", "batch-0")
    store.write(tables.minute.filter(~chat).limit(5), "spans_1m", "batch-1")
    store.compact("spans_1m", day)
    store.write(tables.minute.filter(F.to_date("ts_minute") == F.lit(day)).limit(3), "spans_1m", "batch-2")
    store.compact("spans_1m", day)
    store.write(tables.minute.filter(~chat), "spans_1m", "batch-1")
    store.write(tables.minute.limit(0), "spans_1m", "batch-2")
    kept = store.read("spans_1m").filter(F.col("write_id") != "batch-2")
    assert totals(kept) == raw_totals(tables.spans)
    assert store.compact("spans_1m", day)
    store.vacuum("spans_1m")
    with pytest.raises(ValueError, match="vacuumed"):
        store.write(tables.minute.filter(~chat), "spans_1m", "batch-1")


def test_backfill_over_live_rows_is_refused(spark, tables, store):
    store.write(tables.minute, "spans_1m", "batch-0")
    with pytest.raises(ValueError, match="already has rows"):
        backfill(store, tables.registry, datetime(2024, 1, 5), datetime(2024, 1, 6))


def test_retention(spark, tables, store):
    now = datetime(2024, 1, 20, 6)
    with pytest.raises(ValueError, match="watermark"):
        store.expire("spans_raw", now)
    stalled = store.expire("spans_raw", now, exported_until=datetime(2024, 1, 2, 5))
    assert stalled == ["dt=2024-01-01"]
    deleted = stalled + store.expire("spans_raw", now, exported_until=now)
    assert deleted[-1] == "dt=2024-01-17" and len(deleted) == 17
    kept = store.read("spans_raw", as_of=now)
    expected = tables.spans.filter(F.col("ts") >= F.lit(now - timedelta(hours=48))).count()
    assert kept.count() == expected
    assert store.read("spans_raw").count() > expected


def test_time_range_prunes_days(spark, store):
    df = store.read("spans_raw", datetime(2024, 1, 5), datetime(2024, 1, 6))
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert re.search(r"PartitionFilters: \[[^\n]*dt#\d+ >= 2024-01-05", plan)
    assert {r[0] for r in df.select("dt").distinct().collect()} == {date(2024, 1, 5)}


def test_allowlist_versions(spark, tables, folder):
    store = TableStore(spark, folder)
    assert store.read_allowlist().count() == 0
    assert store.publish_allowlist(tables.allowlist, tables.registry) == 1
    smaller = tables.allowlist.filter(F.col("dimension") != "model")
    assert store.publish_allowlist(smaller, tables.registry) == 2
    assert store.read_allowlist().filter("dimension = 'model'").count() == 0
    assert store.read_allowlist(1).filter("dimension = 'model'").count() == 5
    tight = tables.registry.with_dimension("tenant_id", budget=3)
    with pytest.raises(ValueError, match="tenant_id"):
        store.publish_allowlist(tables.allowlist, tight)
    assert store.allowlist_versions() == [1, 2]


def test_progress_events_become_lag(spark, folder):
    class Event:
        class progress:  # noqa: N801
            id, batchId, timestamp = "q", 3, "2024-01-01T00:00:00.000Z"  # noqa: N815
            json = (
                '{"timestamp": "2024-01-01T00:00:00.000Z", "batchId": 3, "numInputRows": 5,\n'
                ' "sources": [{"endOffset": {"otel.spans": {"0": 10, "1": 4}},'
                ' "latestOffset": {"otel.spans": {"0": 25, "1": 4, "2": 7}}}]}'
            )

    log = ProgressLog(spark, folder + "/progress")
    log.onQueryProgress(Event)
    assert expire_progress(spark, folder + "/progress", datetime(2024, 1, 3), timedelta(days=2)) == []
    (row,) = lag_samples(spark, folder + "/progress").collect()
    assert (row["total_lag"], row["max_partition_lag"], row["partitions"]) == (22, 15, 3)


def test_health_is_recorded_by_minute_without_invented_rows(spark, folder):
    at = datetime(2024, 1, 1)
    lag = spark.createDataFrame(
        [(at + timedelta(seconds=s), v, v, 1) for s, v in ((5, 1), (50, 2), (70, 3), (130, 4))],
        "sampled_at timestamp, total_lag long, max_partition_lag long, partitions long",
    )
    lines = spark.createDataFrame(
        [
            ("2024-01-01 00:00:20", "otelcol_receiver_accepted_spans 10"),
            ("2024-01-01 00:00:40", "otelcol_receiver_accepted_spans 15"),
            ("2024-01-01 00:01:40", "# unreachable"),
            ("2024-01-01 00:02:40", "otelcol_receiver_accepted_spans 30"),
        ],
        "scrape string, line string",
    )
    store = TableStore(spark, folder)
    record_health(store, lag, lines, "sample-1")
    record_health(store, lag, lines, "sample-1")
    rows = store.read("health").orderBy("sampled_at").collect()
    assert [(r["sampled_at"].minute, r["total_lag"], r["accepted_spans"]) for r in rows] == [
        (0, 2, 15),
        (2, 4, 30),
    ]


def test_a_late_scrape_gets_its_minute(spark, folder):
    store = TableStore(spark, folder)
    at = [datetime(2024, 1, 1, 12, m) for m in range(4)]
    lag = spark.createDataFrame([(t, 5, 5, 1) for t in at], "sampled_at timestamp, total_lag long, max_partition_lag long, partitions long")

    def scrapes(minutes):
        rows = [(f"{at[m]:%Y-%m-%d %H:%M:%S}", f"{p} {m + 1}") for m in minutes for p in METRIC_PREFIXES]
        return spark.createDataFrame(rows, "scrape string, line string")

    def recorded():
        rows = store.read("health").orderBy("sampled_at").collect()
        return [(r["sampled_at"], r["accepted_spans"]) for r in rows]

    health_pass(store, lag, scrapes([0, 2]), at[3])
    assert recorded() == [(at[0], 1), (at[2], 3)]
    for _ in range(2):  # the second time as a pass that failed half-way and runs again
        health_pass(store, lag, scrapes([0, 1, 2, 3]), at[3] + timedelta(minutes=1))
        assert recorded() == [(t, m + 1) for m, t in enumerate(at)]


def test_a_batch_replayed_on_another_day_replaces_itself(spark, folder):
    store = TableStore(spark, folder)
    messages = spark.createDataFrame([("{", "t", 0, k) for k in range(5)], "value string, topic string, partition int, offset long")
    for minute, kept in ((datetime(2024, 1, 1, 23, 59), messages), (datetime(2024, 1, 2, 0, 1), messages.limit(3))):
        store.write(dead_letters(kept, minute), "dead_letters", "batch-0")
    rows = store.read("dead_letters").collect()
    assert len(rows) == 3 and {r["ingested_at"] for r in rows} == {datetime(2024, 1, 2, 0, 1)}


def test_minutes_that_lost_late_spans_are_corrected_from_stored_states(spark, tables):
    """A minute short of spans, one never closed and one that is right."""
    states = tables.minute
    minutes = [r[0] for r in states.groupBy("ts_minute").agg(F.sum("spans").alias("n")).filter("n > 1").orderBy("ts_minute").limit(3).collect()]
    some = states.filter(F.col("ts_minute").isin(minutes))
    right, short = (some.filter(F.col("ts_minute") == m) for m in minutes[:2])
    closed = right.unionByName(short.orderBy("spans", *tables.registry.columns).limit(short.count() - 1))
    whole = complete_windows(closed, some)
    assert {(r[0], r[1]) for r in whole.select("ts_minute", "version").collect()} == {(m, int(m != minutes[0])) for m in minutes}
    figures = ["spans", "input_tokens", "errors", "ttft_p95", "traces"]
    want, got = (finalize(x, ["ts_minute"]).select("ts_minute", *figures).collect() for x in (some, whole))
    assert sorted(want) == sorted(got)


def test_redelivered_spans_are_written_in_the_parts_they_are_read_in(spark, sf_dir, tmp_path, monkeypatch):
    """A fixed number of files would let each task read a share of the whole log."""
    monkeypatch.setattr("registered.queries.scratch_dir", lambda _, name: f"{tmp_path}/{name}")
    parts = Tables(spark, sf_dir).redelivered.repartition(7, "ts")
    monkeypatch.setattr(Tables, "redelivered", parts)
    row = queries()["j07_dedup_stream"](spark, sf_dir).first()
    assert row["rows"] == row["spans"] > 0
    assert len(list(tmp_path.glob("redelivered/*.parquet"))) == 7

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanloom.sources.archive import SpanArchive
from spanloom.sources.commits import CommitConflict
from spanloom.sources.tables import TableStore

FEW = 4


@pytest.fixture
def spans(tables):
    """A week, with redelivered copies."""
    week = tables.redelivered.filter("ts < '2024-01-08'")
    return week.withColumn("attributes", F.create_map().cast("map<string,string>"))


@pytest.fixture
def store(spark, folder):
    return TableStore(spark, f"{folder}/hot")


def same(archive, spans):
    kept = archive.read().select("span_id", "tenant_id", "output_tokens")
    want = spans.select("span_id", "tenant_id", "output_tokens").distinct()
    return kept.exceptAll(want).count() == 0 and want.exceptAll(kept).count() == 0


def test_every_span_once(spark, store, spans, folder):
    archive = SpanArchive(spark, f"{folder}/archive", FEW)
    assert archive.sync(store) is None and archive.loads().count() == 0
    part = F.pmod(F.xxhash64("span_id"), F.lit(3))
    store.write(spans.filter(part < 2), "spans_raw", "batch-0")
    archive.sync(store)
    # Late rows and copies of known ones in one write, and a span delivered very often.
    store.write(spans.filter(part > 0), "spans_raw", "batch-1")
    often = spans.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("n")
    store.write(often, "spans_raw", "batch-2")
    assert {r["write_id"] for r in archive.pending(store).collect()} == {"batch-1", "batch-2"}
    archive.sync(store)
    assert archive.sync(store) is None
    assert same(archive, spans)
    total = spans.select("span_id").distinct().count()
    assert archive.loads().agg(F.sum("kept")).first()[0] == archive.keys().count() == total
    day = archive.read(datetime(2024, 1, 3), datetime(2024, 1, 4))
    assert day.count() == spans.filter("ts >= '2024-01-03' AND ts < '2024-01-04'").select("span_id").distinct().count()


def test_stored_side_is_not_shuffled(spark, store, spans, folder):
    archive = SpanArchive(spark, f"{folder}/archive", FEW)
    store.write(spans, "spans_raw", "batch-0")
    archive.sync(store)
    days = [r[0] for r in spans.select(F.to_date("ts")).distinct().collect()]
    plan = archive.unknown(spans, days)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    stored = plan[plan.index("SortMergeJoin") :].splitlines()
    depth = {line.index("FileScan"): k for k, line in enumerate(stored) if "archive_keys" in line}
    (at,) = depth.values()
    # Upwards from the scan of the stored ids to the join: no Exchange.
    indent = stored[at].index("FileScan")
    above = [line for line in stored[1:at] if "Exchange" in line and line.index("Exchange") < indent]
    left = [line for line in above if "+- Exchange" in line or ":- Exchange" in line]
    assert all(line.lstrip().startswith(":") for line in left), plan
    assert "Bucketed: true" in stored[at] and f"SelectedBucketsCount: {FEW} out of {FEW}" in stored[at]


def test_only_new_writes_are_read(spark, store, spans, folder):
    archive = SpanArchive(spark, f"{folder}/archive", FEW)
    store.write(spans, "spans_raw", "batch-0")
    archive.sync(store)
    store.write(spans.limit(50), "spans_raw", "batch-1")
    writes = [(r["dt"], r["write_id"]) for r in archive.pending(store).collect()]
    read = store.read_writes("spans_raw", writes).inputFiles()
    assert read and all("write_id=batch-1" in f for f in read)


def test_compacted_writes_are_recognised(spark, store, spans, folder):
    archive = SpanArchive(spark, f"{folder}/archive", FEW)
    part = F.pmod(F.xxhash64("span_id"), F.lit(2))
    store.write(spans.filter(part == 0), "spans_raw", "batch-0")
    archive.sync(store)
    store.write(spans.filter(part == 1), "spans_raw", "batch-1")
    store.compact("spans_raw", datetime(2024, 1, 3).date())
    archive.sync(store)
    assert same(archive, spans)


def test_a_sync_that_comes_second_is_undone(spark, store, spans, folder, monkeypatch):
    archive = SpanArchive(spark, f"{folder}/archive", FEW)
    store.write(spans, "spans_raw", "batch-0")
    real = archive._append

    def slow(*args):
        SpanArchive(spark, f"{folder}/archive", FEW).sync(store)
        return real(*args)

    monkeypatch.setattr(archive, "_append", slow)
    with pytest.raises(CommitConflict):
        archive.sync(store)
    monkeypatch.undo()
    assert archive.sync(store) is None and same(archive, spans)
    assert archive._unfinished("spans", "window") == archive._unfinished("keys", "load") == []


def test_a_load_that_was_not_committed_is_invisible(spark, store, spans, folder):
    archive = SpanArchive(spark, f"{folder}/archive", FEW)
    store.write(spans, "spans_raw", "batch-0")
    days = [r[0] for r in spans.select(F.to_date("ts")).distinct().collect()]
    archive._append(store.read("spans_raw"), "load-lost", days)
    assert archive.read().count() == archive.keys().count() == 0
    archive.sync(store)
    assert same(archive, spans)
    assert archive.read(datetime(2024, 1, 1) - timedelta(days=1)).count() == archive.keys().count()

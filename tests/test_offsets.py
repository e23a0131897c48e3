from datetime import datetime

from pyspark.sql import functions as F

from spanloom.operators import offsets
from spanloom.sources.tables import TableStore
from spanloom.streaming.ingest import ingest_batch

AT = datetime(2024, 1, 1)
SCHEMA = "value string, topic string, partition int, offset long"


def batch(spark, *ranges):
    rows = [("{}", "t", p, o) for p, low, high in ranges for o in range(low, high + 1)]
    return spark.createDataFrame(rows, SCHEMA)


def gaps(ledger):
    return sorted((r["partition"], r["from_offset"], r["to_offset"]) for r in offsets.offset_gaps(ledger).collect())


def test_gaps_between_batches_whatever_their_order(spark):
    one = offsets.consumed_ranges(batch(spark, (0, 0, 9), (1, 5, 7)), AT)
    two = offsets.consumed_ranges(batch(spark, (0, 20, 29), (1, 8, 12)), AT)
    three = offsets.consumed_ranges(batch(spark, (0, 12, 25), (0, 40, 41)).repartition(3), AT)
    assert gaps(one.unionByName(two)) == [(0, 10, 19)]
    assert gaps(three.unionByName(two).unionByName(one)) == [(0, 10, 11)]
    assert gaps(one.limit(0)) == []


def test_holes_inside_a_range(spark):
    rows = batch(spark, (0, 0, 9), (0, 9, 9)).filter("offset NOT IN (3, 4)")
    (row,) = offsets.offset_holes(offsets.consumed_ranges(rows, AT)).collect()
    assert (row["missing"], row["messages"]) == (2, 8)
    far = spark.createDataFrame([("{}", "t", 0, 5), ("{}", "t", 0, 5 + 3 * offsets.SLICE)], SCHEMA)
    assert gaps(offsets.consumed_ranges(far, AT)) == [(0, 6, 4 + 3 * offsets.SLICE)]


def test_skipped_offsets_become_dead_letters_once(spark, tables, folder):
    store = TableStore(spark, folder)
    store.publish_allowlist(tables.allowlist, tables.registry)
    first, second = batch(spark, (0, 0, 9), (1, 0, 3)), batch(spark, (0, 15, 19), (1, 4, 6))
    for n, messages in ((0, first), (1, second), (1, second)):
        ingest_batch(messages, n, store, tables.registry, record_losses=True)
    lost = store.read("dead_letters").filter(F.col("error") == offsets.LOST).collect()
    assert [(r["partition"], r["offset"], r["raw_message"]) for r in lost] == [(0, 10, "10-14")]
    assert gaps(store.read("offsets")) == [(0, 10, 14)]

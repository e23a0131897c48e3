"""The continuous chain: messages to raw spans, dead letters, minute and hour states, frequent values.

Each micro-batch writes its own partial states under its batch id; readers merge
them. That makes every step stateless: late spans always count, totals equal the
raw rows at every moment, and a replayed batch replaces what it wrote before.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spanloom.operators.decode import dead_letters_of, decode_messages, spans_of
from spanloom.operators.guard import guard_dimensions
from spanloom.operators.heavy import value_states
from spanloom.operators.offsets import consumed_ranges, lost_before
from spanloom.operators.rollup import MINUTE, initial_states, merge_states, rollup_1h, rollup_1m
from spanloom.registry import Registry
from spanloom.schema import DIMENSION_COLUMNS
from spanloom.sources.tables import TableStore


def _write_states(
    spans: DataFrame, write_id: str, store: TableStore, registry: Registry
) -> None:
    # The newest allowlist snapshot, read again for every batch.
    minute = rollup_1m(spans, store.read_allowlist(), registry).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        store.write(minute, "spans_1m", write_id)
        store.write(rollup_1h(minute), "spans_1h", write_id)
    finally:
        minute.unpersist()


def _stream_id(batch: DataFrame) -> str:
    """Identity of the stream a micro-batch belongs to; it lives in the stream's checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def ingest_batch(
    messages: DataFrame,
    batch_id: int,
    store: TableStore,
    registry: Registry,
    stream_id: str = "manual",
    record_losses: bool = False,
) -> None:
    """Process one block of messages; running it again with the same ids changes nothing.

    ``record_losses`` enters the offsets it covers in the ledger, and what was skipped since
    the batches before as dead letters. It reads the messages' offsets once more, and is for
    sources that hand out a partition's messages in order but may leave some out.

    Batch numbers start at 0 in every stream, so a write is named by both.

    The tables are written side by side, so that the tail of one write does not
    leave the cluster idle. The batch fails if any of them does.
    """
    write_id = f"batch-{stream_id}-{batch_id:012d}"
    arrived = datetime.now(UTC)
    # Read for each of the tables. Lost blocks are decoded again from the source.
    decoded = decode_messages(messages, arrived).persist(StorageLevel.MEMORY_AND_DISK)
    spans, dead = spans_of(decoded), dead_letters_of(decoded)
    ledger: tuple = ()
    if record_losses:
        covered = consumed_ranges(messages, arrived)
        earlier = store.read("offsets").filter(F.col("write_id") < write_id)
        dead = dead.unionByName(lost_before(covered, earlier, arrived).select(*dead.columns))
        ledger = (lambda: store.write(covered, "offsets", write_id),)
    writes = (
        lambda: store.write(spans, "spans_raw", write_id),
        lambda: store.write(dead, "dead_letters", write_id),
        lambda: _write_states(spans, write_id, store, registry),
        lambda: store.write(value_states(spans, registry), "values_1m", write_id),
        *ledger,
    )
    try:
        with ThreadPoolExecutor(len(writes)) as pool:
            # Inherits the stream's job group: stopping it stops these jobs too.
            inherit = inheritable_thread_target(messages.sparkSession)
            running = [pool.submit(inherit(write)) for write in writes]
        for write in running:
            write.result()
    finally:
        decoded.unpersist()


def start_ingest(
    messages: DataFrame,
    store: TableStore,
    registry: Registry,
    checkpoint: str,
    trigger: dict | None = None,
    record_losses: bool = False,
) -> StreamingQuery:
    """Run the chain over a message stream. The default trigger is every minute.

    A longer trigger makes fewer, larger files; ``availableNow`` drains and stops.
    """
    return (
        messages.writeStream.queryName("span_ingest")
        .foreachBatch(
            lambda batch, n: ingest_batch(
                batch, n, store, registry, _stream_id(batch), record_losses
            )
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def once_per_span(spans: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop redelivered spans of a stream that arrive within ``delay`` of event time."""
    return spans.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["span_id"])


def windowed_states(
    spans: DataFrame,
    allowlist: DataFrame,
    registry: Registry,
    delay: str = "10 minutes",
) -> DataFrame:
    """Minute states kept in streaming state and emitted when a minute closes.

    Gives one row per key and minute, at the price of a delay; spans later than the
    watermark are not in it, nor are minutes still open. ``complete_windows`` adds
    both from the states the batches stored. The stateless chain is the default.
    """
    marked = spans.withWatermark("ts", delay).withColumn(
        "__failed", F.col("status_class") != "ok"
    )
    guarded = guard_dimensions(marked, allowlist, registry)
    states = guarded.groupBy(F.window("ts", "1 minute").alias("w"), *registry.columns).agg(
        *initial_states()
    )
    rest = [c for c in states.columns if c != "w"]
    return states.select(F.col("w.start").alias(MINUTE), *rest)


def complete_windows(closed: DataFrame, states: DataFrame) -> DataFrame:
    """Closed minutes, with those corrected whose span count differs from the stored minute states.

    That covers minutes a watermark has not closed yet and minutes that lost late spans: their
    rows are merged from the partial states that the batches wrote. Raw spans are not read.
    ``version`` is 0 for a minute as the watermark closed it and 1 for a corrected one.
    """
    held = closed.groupBy(MINUTE).agg(F.sum("spans").alias("__held"))
    due = states.groupBy(MINUTE).agg(F.sum("spans").alias("__due"))
    stale = (
        due.join(held, MINUTE, "left")
        .filter(~F.col("__due").eqNullSafe(F.col("__held")))
        .select(MINUTE)
    )
    again = states.join(stale, MINUTE, "left_semi")
    fresh = merge_states(again, [MINUTE, *DIMENSION_COLUMNS]).withColumn("version", F.lit(1))
    kept = closed.join(stale, MINUTE, "left_anti").withColumn("version", F.lit(0))
    return kept.unionByName(fresh.select(*kept.columns))

"""Tables the registered queries read, all derived by Spark from the given event log.

Stored tables (hot store, lake, message files) are written once per session and
data folder, into the shared scratch folder, and reused by the queries after it.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.operators.guard import build_allowlist
from spanloom.operators.rollup import rollup_1h, rollup_1m
from spanloom.registry import Registry, default_registry
from spanloom.session import prepare, scratch_dir
from spanloom.sources import events as E
from spanloom.sources.archive import SpanArchive
from spanloom.sources.lake import run_export
from spanloom.sources.messages import read_message_files
from spanloom.sources.tables import TableStore
from spanloom.streaming.ingest import start_ingest

FIRST = datetime(2024, 1, 1)
LAST = datetime(2024, 2, 1)
PERIOD = (FIRST, LAST)
HALFWAY = datetime(2024, 1, 16)

# Message files come in multiples of 8, with so many spans in a file at most.
FILES, SPANS_A_FILE = 8, 100_000

_written: dict[tuple[str, str, str], str] = {}


def registry() -> Registry:
    """The shipped registry with a tenant budget small enough to bite on the test data."""
    return default_registry().with_dimension("tenant_id", budget=50, top_k_window_hours=24 * 32)


class Tables:
    """Lazy frames for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir
        self.registry = registry()
        self.events = E.read_events(spark, sf_dir)

    @cached_property
    def spans(self) -> DataFrame:
        return E.spans_from_events(self.events, self.registry)

    @cached_property
    def redelivered(self) -> DataFrame:
        return E.spans_with_redelivery(self.events, self.registry)

    @cached_property
    def allowlist(self) -> DataFrame:
        return build_allowlist(self.spans, self.registry, LAST)

    @cached_property
    def minute(self) -> DataFrame:
        return rollup_1m(self.spans, self.allowlist, self.registry)

    @cached_property
    def hour(self) -> DataFrame:
        return rollup_1h(self.minute)

    @property
    def counted(self) -> DataFrame:
        """The spans that the minute states were made of."""
        return self.spans

    @cached_property
    def health(self) -> DataFrame:
        return E.health_from_events(self.events)

    @cached_property
    def message_parts(self) -> int:
        """How many files the messages make: one is packed and unpacked by one task, so they do not grow with the log."""
        return FILES * max(1, -(-self.events.count() // (FILES * SPANS_A_FILE)))

    @cached_property
    def messages(self) -> DataFrame:
        """One whole message per trace, and a damaged copy beside every thirteenth."""
        # Traces are gathered in the parts they are written in; the text is not shuffled again.
        dealt = self.spans.repartition(self.message_parts, "trace_id")
        messages = E.messages_from_spans(dealt, "trace_id")
        copied = F.substring("trace_id", 2, 20).cast("bigint") % 13 == 0
        whole = F.struct("value", "topic", "partition", "offset")
        damaged = F.struct(
            F.substring("value", 1, 200).alias("value"),
            "topic",
            "partition",
            (F.col("offset") + F.lit(1 << 41)).alias("offset"),
        )
        # Each message is written once, whether it is copied or not.
        sent = F.when(copied, F.array(whole, damaged)).otherwise(F.array(whole))
        return messages.select(F.inline(sent))

    # --- stored tables --------------------------------------------------------

    def _once(self, name: str, write) -> str:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _written:
            path = scratch_dir(self.spark, name)
            write(path)
            _written[key] = path
        return _written[key]

    @property
    def message_files(self) -> str:
        def write(path: str) -> None:
            # As text the messages take ten times what they take packed.
            self.messages.write.option("compression", "gzip").json(path)

        return self._once("messages", write)

    def message_stream(self, batches: int) -> DataFrame:
        """The message files as a stream of so many batches, a divisor of ``FILES``."""
        return read_message_files(self.spark, self.message_files, max_files=self.message_parts // batches)

    @property
    def store(self) -> TableStore:
        """The hot tables, filled by the streaming chain from the message files."""

        def write(path: str) -> None:
            store = TableStore(self.spark, path)
            store.publish_allowlist(self.allowlist, self.registry)
            stream = self.message_stream(batches=2)
            checkpoint = scratch_dir(self.spark, "ingest-checkpoint")
            start_ingest(
                stream, store, self.registry, checkpoint, {"availableNow": True}
            ).awaitTermination()

        return TableStore(self.spark, self._once("hot", write))

    @property
    def lake(self) -> str:
        """The lake, exported in day windows from the spans with redelivered copies."""

        def write(path: str) -> None:
            outcomes = run_export(
                self.redelivered, path, now=LAST + timedelta(minutes=5), window=timedelta(days=1)
            )
            failed = outcomes.filter("status = 'failed'").select("reason").first()
            if failed:
                raise RuntimeError(failed["reason"])

        return self._once("lake", write)

    @property
    def archive(self) -> SpanArchive:
        """Every span once, from two writes of redelivered spans: those that arrived by ``HALFWAY``, and the rest."""
        clusters = 8

        def write(path: str) -> None:
            store = TableStore(self.spark, scratch_dir(self.spark, "redelivered-hot"))
            archive = SpanArchive(self.spark, path, clusters)
            rows = self.redelivered.withColumn("attributes", F.create_map().cast("map<string,string>"))
            early = F.col("ingested_at") < F.lit(HALFWAY)
            for name, part in (("batch-0", early), ("batch-1", ~early)):
                store.write(rows.filter(part), "spans_raw", name)
                archive.sync(store)

        return SpanArchive(self.spark, self._once("archive", write), clusters)


class StreamedTables(Tables):
    """The same, with the states that the ingest stream wrote batch by batch."""

    @cached_property
    def minute(self) -> DataFrame:
        return self.store.read("spans_1m")

    @cached_property
    def hour(self) -> DataFrame:
        return self.store.read("spans_1h")

    @property
    def counted(self) -> DataFrame:
        return self.store.read("spans_raw")


def comparable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating-point columns, whose last digits depend on the order of addition."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            F.round(F.col(f.name).cast("double"), digits).alias(f.name)
            if isinstance(f.dataType, floating)
            else F.col(f.name)
            for f in df.schema
        ]
    )

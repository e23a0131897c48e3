"""Consumer lag, collector counters and the samples made of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.ordered import with_previous
from spanloom.schema import HEALTH_COUNTERS

# Counter name at the start of a metrics line -> column (fixed values).
METRIC_PREFIXES = {
    "otelcol_receiver_accepted_spans": "accepted_spans",
    "otelcol_receiver_refused_spans": "refused_spans",
    "otelcol_exporter_sent_spans": "sent_spans",
    "otelcol_exporter_send_failed_spans": "send_failed_spans",
    "otelcol_exporter_enqueue_failed_spans": "enqueue_failed_spans",
    "otelcol_exporter_queue_size": "queue_size",
    "otelcol_exporter_queue_capacity": "queue_capacity",
}


def parse_metrics(lines: DataFrame) -> DataFrame:
    """Metrics text ``(scrape, line)`` to one row of counters per scrape.

    Series of one counter are added up. Comments and lines without a number are
    skipped. A scrape in which nothing could be read gives no row, and a counter
    missing from a readable scrape is 0.
    """
    text = F.col("line")
    number = F.element_at(F.split(text, " "), -1).try_cast("double")
    counter = F.lit(None).cast("string")
    for prefix, column in METRIC_PREFIXES.items():
        counter = F.when(text.startswith(prefix), column).otherwise(counter)
    read = (
        lines.filter(~text.startswith("#") & (F.trim(text) != ""))
        .select("scrape", counter.alias("counter"), number.alias("n"))
        .filter(F.col("counter").isNotNull() & F.col("n").isNotNull())
    )
    return read.groupBy("scrape").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("counter") == c, F.col("n"))), F.lit(0.0))
            .cast("bigint")
            .alias(c)
            for c in HEALTH_COUNTERS
        ]
    )


def partition_lag(high: DataFrame, committed: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Messages not yet read per partition. Without a commit everything is outstanding.

    Partition numbers repeat between topics and streams: where the offsets carry
    ``query_id`` or ``topic``, those are part of the key.
    """
    keys = [*by, *[c for c in ("query_id", "topic") if c in high.columns], "partition"]
    position = F.greatest(F.coalesce(F.col("committed"), F.lit(0)), F.lit(0))
    return high.join(committed, keys, "left").select(
        *keys,
        "high",
        position.alias("position"),
        F.greatest(F.col("high") - position, F.lit(0)).cast("bigint").alias("lag"),
    )


def consumer_lag(high: DataFrame, committed: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Total lag, the worst partition's lag and the number of partitions."""
    zero = F.lit(0).cast("bigint")
    return (
        partition_lag(high, committed, by)
        .groupBy(*by)
        .agg(
            F.coalesce(F.sum("lag"), zero).alias("total_lag"),
            F.coalesce(F.max("lag"), zero).alias("max_partition_lag"),
            F.count("*").alias("partitions"),
        )
    )


def health_rows(lag: DataFrame, counters: DataFrame) -> DataFrame:
    """Samples ``(sampled_at, lag, counters)``. A sample whose scrape failed gives no row."""
    rows = lag.join(counters, "sampled_at", "inner")
    for c in HEALTH_COUNTERS:
        rows = rows.filter(F.col(c).isNotNull())
    return rows.select(
        "sampled_at", "total_lag", "max_partition_lag", "partitions", *HEALTH_COUNTERS
    )


def dropped() -> Column:
    """Spans lost on the way out: retries used up, or the queue was full."""
    return F.col("send_failed_spans") + F.col("enqueue_failed_spans")


def latest_sample(health: DataFrame) -> DataFrame:
    """The newest sample, found by a maximum rather than a sort."""
    columns = [c for c in health.columns if c != "sampled_at"]
    newest = health.agg(
        F.max("sampled_at").alias("sampled_at"),
        F.max_by(F.struct(*columns), "sampled_at").alias("r"),
    )
    return newest.filter(F.col("sampled_at").isNotNull()).select("sampled_at", "r.*")


def counter_growth(health: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """How much cumulative counters grew since the sample before, never negative.

    The first sample has nothing to compare with and counts as 0. A counter that
    fell was reset, and also counts as 0.
    """
    values = health.select("sampled_at", *[c.cast("bigint").alias(n) for n, c in counters.items()])
    compared = with_previous(
        values, "sampled_at", list(counters), F.date_trunc("hour", "sampled_at")
    )
    zero = F.lit(0).cast("bigint")
    return compared.select(
        F.col("sampled_at").alias("time"),
        *[
            F.greatest(zero, F.coalesce(F.col(n) - F.col(f"prev_{n}"), zero)).alias(n)
            for n in counters
        ],
    )

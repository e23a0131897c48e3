"""Dashboard queries over the rollup states, the health samples and the raw spans.

Each takes the table it reads and a closed time range; None leaves a side open.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.quantiles import with_quantiles
from spanloom.functions.scalars import instant, measured, minute_of, ratio, single_row
from spanloom.operators import guard, health, quality
from spanloom.operators.rollup import MINUTE, finalize
from spanloom.registry import Registry

Range = tuple[datetime | None, datetime | None]
ALL: Range = (None, None)


def between(df: DataFrame, column: str, period: Range) -> DataFrame:
    """Closed range on a time column; prunes day partitions where the table has them."""
    start, end = period
    if start is not None:
        df = df.filter(F.col(column) >= instant(start))
        if "dt" in df.columns:
            df = df.filter(F.col("dt") >= F.lit(start.date()))
    if end is not None:
        df = df.filter(F.col(column) <= instant(end))
        if "dt" in df.columns:
            df = df.filter(F.col("dt") <= F.lit(end.date()))
    return df


def _seconds(period: Range, window_seconds: float | None) -> float:
    """Length of the range, unless the caller fixes the divisor."""
    if window_seconds is not None:
        return float(window_seconds)
    start, end = period
    if start is None or end is None:
        raise ValueError("a rate needs a closed range or window_seconds")
    return (end - start).total_seconds()


def _per_minute(states: DataFrame, period: Range, *extra: str) -> DataFrame:
    minute = F.col(MINUTE).alias("time")
    return finalize(between(states, MINUTE, period), [minute, *[F.col(c) for c in extra]])


def _total(states: DataFrame, period: Range) -> DataFrame:
    return finalize(between(states, MINUTE, period))


# --- workload -----------------------------------------------------------------


def spans_per_second(
    states: DataFrame, period: Range = ALL, window_seconds: float | None = None
) -> DataFrame:
    seconds = _seconds(period, window_seconds)
    return _total(states, period).select((F.col("spans") / F.lit(seconds)).alias("value"))


def traces(states: DataFrame, period: Range = ALL) -> DataFrame:
    """Distinct traces, from mergeable sketches: 1.6 % off (one sigma) beyond 4,096."""
    return _total(states, period).select(F.coalesce("traces", F.lit(0)).alias("value"))


def exact_traces(spans: DataFrame, period: Range = ALL) -> DataFrame:
    """Distinct traces, counted in the spans of the same minutes; reads their time and trace id only."""
    timed = spans.withColumn(MINUTE, minute_of(F.col("ts")))
    return between(timed, MINUTE, period).agg(F.count_distinct("trace_id").alias("value"))


def output_tokens_per_second(
    states: DataFrame, period: Range = ALL, window_seconds: float | None = None
) -> DataFrame:
    seconds = _seconds(period, window_seconds)
    return _total(states, period).select((F.col("output_tokens") / F.lit(seconds)).alias("value"))


def error_rate(states: DataFrame, period: Range = ALL) -> DataFrame:
    return _total(states, period).select(F.col("error_rate").alias("value"))


def kv_cache_max(states: DataFrame, period: Range = ALL) -> DataFrame:
    return _total(states, period).select(F.col("kv_cache_max").alias("value"))


def active_tenants(states: DataFrame, registry: Registry, period: Range = ALL) -> DataFrame:
    """Tenants that can be named, so without the sentinels."""
    return (
        between(states, MINUTE, period)
        .filter(~F.col("tenant_id").isin(*registry.sentinels))
        .agg(F.count_distinct("tenant_id").alias("value"))
    )


def token_throughput(states: DataFrame, period: Range = ALL) -> DataFrame:
    return (
        _per_minute(states, period).select("time", "input_tokens", "output_tokens").orderBy("time")
    )


def time_to_first_token(states: DataFrame, period: Range = ALL) -> DataFrame:
    return (
        _per_minute(states, period)
        .select(
            "time",
            F.col("ttft_p50").alias("p50"),
            F.col("ttft_p95").alias("p95"),
            F.col("ttft_p99").alias("p99"),
        )
        .orderBy("time")
    )


def exact_time_to_first_token(spans: DataFrame, period: Range = ALL) -> DataFrame:
    """The same panel from the spans of those minutes: observed values, not middles of buckets.

    A minute without measured values has a row of nulls.
    """
    timed = spans.select(minute_of(F.col("ts")).alias("time"), measured(F.col("ttft_ms")).alias("ttft"))
    timed = between(timed, "time", period)
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    minutes = timed.select("time").distinct()
    return with_quantiles(minutes, timed, ["time"], F.col("ttft"), shares, "disc").orderBy("time")


def ttft_by_model(states: DataFrame, registry: Registry, period: Range = ALL) -> DataFrame:
    """Spans without a model are left out; unregistered models stay in."""
    named = states.filter(F.col("model") != registry.none_bucket)
    return (
        _per_minute(named, period, "model")
        .select("time", "model", F.col("ttft_p95").alias("p95"))
        .orderBy("time", "model")
    )


def kv_cache_series(states: DataFrame, period: Range = ALL) -> DataFrame:
    return (
        _per_minute(states, period)
        .select("time", F.col("kv_cache_avg").alias("avg"), F.col("kv_cache_max").alias("max"))
        .orderBy("time")
    )


def top_tenants(states: DataFrame, period: Range = ALL, limit: int = 20) -> DataFrame:
    """Busiest tenants. A tenant seen with several tiers shows the first by name."""
    tier = F.min("tenant_tier").alias("tier")
    return (
        finalize(between(states, MINUTE, period), ["tenant_id"], [tier])
        .select(
            F.col("tenant_id").alias("tenant"),
            "tier",
            F.col("spans").alias("span_count"),
            F.col("traces").alias("trace_count"),
            "output_tokens",
            F.round("ttft_p95", 1).alias("ttft_p95_ms"),
            F.round("error_rate", 4).alias("error_rate"),
        )
        .orderBy(F.desc("span_count"), "tenant")
        .limit(limit)
    )


def errors_by_class(states: DataFrame, period: Range = ALL) -> DataFrame:
    failed = states.filter(F.col("status_class") != "ok")
    return (
        _per_minute(failed, period, "status_class")
        .select("time", "status_class", F.col("spans").alias("error_spans"))
        .orderBy("time", "status_class")
    )


# --- health of the chain ------------------------------------------------------


def current_lag(samples: DataFrame) -> DataFrame:
    return health.latest_sample(samples).select(F.col("total_lag").alias("value"))


def dropped_total(samples: DataFrame) -> DataFrame:
    return health.latest_sample(samples).select(health.dropped().alias("value"))


def export_queue(samples: DataFrame) -> DataFrame:
    """Share of the export queue in use; null when its capacity is 0."""
    return health.latest_sample(samples).select(
        ratio(F.col("queue_size"), F.col("queue_capacity")).alias("value")
    )


def refused_spans(samples: DataFrame) -> DataFrame:
    return health.latest_sample(samples).select(F.col("refused_spans").alias("value"))


def active_files(files_per_day: DataFrame) -> DataFrame:
    """Files that make up a table: many small ones are an early warning."""
    return files_per_day.agg(F.coalesce(F.sum("files"), F.lit(0)).alias("value"))


def lag_series(samples: DataFrame, period: Range = ALL) -> DataFrame:
    return (
        between(samples, "sampled_at", period)
        .select(
            F.col("sampled_at").alias("time"),
            "total_lag",
            F.col("max_partition_lag").alias("worst_partition"),
        )
        .orderBy("time")
    )


def dropped_per_sample(samples: DataFrame, period: Range = ALL) -> DataFrame:
    ranged = between(samples, "sampled_at", period)
    return health.counter_growth(ranged, {"dropped": health.dropped()}).orderBy("time")


def ingest_latency(spans: DataFrame, period: Range = ALL) -> DataFrame:
    return quality.latency_by_minute(between(spans, "ts", period))


def collector_throughput(samples: DataFrame, period: Range = ALL) -> DataFrame:
    ranged = between(samples, "sampled_at", period)
    return health.counter_growth(
        ranged, {"accepted": F.col("accepted_spans"), "sent": F.col("sent_spans")}
    ).orderBy("time")


# --- cardinality --------------------------------------------------------------


def _sentinel_sum(states: DataFrame, registry: Registry, sentinel: str) -> DataFrame:
    """Spans in a sentinel, added up over the dimensions; a span may count once for each."""
    hits = sum(
        (F.when(F.col(d.column) == sentinel, 1).otherwise(0) for d in registry.dimensions),
        F.lit(0),
    )
    return states.agg(F.coalesce(F.sum(F.col("spans") * hits), F.lit(0)).alias("value"))


def unregistered_spans(states: DataFrame, registry: Registry, period: Range = ALL) -> DataFrame:
    """An absolute count: any value above 0 calls for action."""
    return _sentinel_sum(between(states, MINUTE, period), registry, registry.other_bucket)


def absent_dimensions(states: DataFrame, registry: Registry, period: Range = ALL) -> DataFrame:
    """Routine, and never added to the unregistered spans."""
    return _sentinel_sum(between(states, MINUTE, period), registry, registry.none_bucket)


def worst_minute(states: DataFrame, registry: Registry, period: Range = ALL) -> DataFrame:
    """Most rollup rows in any one minute, beside the bound the registry sets.

    Rows of one key in different batches count once.
    """
    keys = between(states, MINUTE, period).select(MINUTE, *registry.columns).distinct()
    per_minute = keys.groupBy(MINUTE).agg(F.count("*").alias("n"))
    return per_minute.agg(F.coalesce(F.max("n"), F.lit(0)).alias("value")).withColumn(
        "bound", F.lit(registry.max_rows_per_bucket).cast("bigint")
    )


def rollup_compression(spans: DataFrame, states: DataFrame) -> DataFrame:
    """Raw rows per rollup row."""
    raw = spans.agg(F.count("*").alias("rows"))
    rolled = single_row(states.agg(F.count("*").alias("rows")))
    return raw.select(F.round(ratio(F.col("rows"), rolled["rows"]), 1).alias("value"))


def which_unregistered(
    spans: DataFrame,
    allowlist: DataFrame,
    registry: Registry,
    period: Range = ALL,
    limit: int = 50,
) -> DataFrame:
    """The offending values by name. The rollup no longer knows them, so raw spans are read."""
    return guard.unregistered_values(between(spans, "ts", period), allowlist, registry, limit)


def bucket_breakdown(states: DataFrame, registry: Registry, period: Range = ALL) -> DataFrame:
    return guard.bucket_breakdown(between(states, MINUTE, period), registry)


def unregistered_series(states: DataFrame, registry: Registry, period: Range = ALL) -> DataFrame:
    return (
        between(states, MINUTE, period)
        .groupBy(F.col(MINUTE).alias("time"))
        .agg(
            *[
                F.sum(
                    F.when(F.col(d.column) == registry.other_bucket, F.col("spans")).otherwise(0)
                ).alias(d.name)
                for d in registry.dimensions
            ]
        )
        .orderBy("time")
    )

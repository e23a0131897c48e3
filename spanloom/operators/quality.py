"""Ingest latency and data-quality audits of the raw spans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import sketches as K
from spanloom.functions.quantiles import with_quantiles
from spanloom.functions.scalars import ingest_latency_s, instant, measured, minute_of, single_row

# Messages of lag up to which the consumer counts as keeping up (fixed value).
DRAINED_LAG = 500


def latency_stats(
    spans: DataFrame,
    lag: DataFrame | None,
    start: datetime | None = None,
    end: datetime | None = None,
    exact: bool = True,
) -> DataFrame:
    """Seconds from span end to arrival: count, mean, three quantiles and maximum.

    The window is on event time: rows picked by arrival would be those that waited. While a
    backlog drains, latency describes the backlog, so the plan reads ``lag`` (a row with
    ``total_lag``, as ``consumer_lag`` gives) and fails on more than ``DRAINED_LAG`` messages
    or without a row. ``None`` measures whatever the lag is.
    """
    if start is not None:
        spans = spans.filter(F.col("ts") >= instant(start))
    if end is not None:
        spans = spans.filter(F.col("ts") < instant(end))
    latency = ingest_latency_s()
    timed = spans.select(latency.alias("s"))
    if lag is not None:
        waiting = single_row(lag.agg(F.max("total_lag").alias("n")))["n"]
        told = F.concat(F.lit("latency asked for with a lag of "), F.coalesce(waiting.cast("string"), F.lit("unknown size")))
        drained = F.coalesce(waiting <= DRAINED_LAG, F.lit(False))
        timed = timed.select(F.when(drained, F.col("s")).otherwise(F.raise_error(told)).alias("s"))
    names = {"p50_s": 0.5, "p95_s": 0.95, "p99_s": 0.99}
    figures = [F.count("*").alias("n"), F.avg("s").alias("avg_s"), F.max("s").alias("max_s")]
    order = ["n", "avg_s", *names, "max_s"]
    if exact:
        base = timed.agg(*figures)
        return with_quantiles(base, timed, [], F.col("s"), names).select(*order)
    sketched = timed.agg(*figures, K.quantile_state(F.col("s")).alias("q"))
    sketched = sketched.withColumn("q", K.bucket_counts(F.col("q")))
    return sketched.select(
        "*", *[K.read_quantile(F.col("q"), p).alias(c) for c, p in names.items()]
    ).select(*order)


def latency_by_minute(spans: DataFrame) -> DataFrame:
    """Median and 95th percentile of ingest latency per minute of event time."""
    timed = spans.select(minute_of(F.col("ts")).alias("time"), ingest_latency_s().alias("s"))
    counted = timed.groupBy("time").agg(F.count("*").alias("spans"))
    return (
        with_quantiles(counted, timed, ["time"], F.col("s"), {"p50": 0.5, "p95": 0.95})
        .select("time", "p50", "p95")
        .orderBy("time")
    )


def quality_counts(spans: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Rows with missing identifiers, impossible times or durations, and present measures."""
    now = instant(as_of)

    def empty(column: str) -> Column:
        return F.count_if(F.col(column) == "").alias(f"no_{column}")

    chat = F.col("operation") == "chat"
    kv = F.col("kv_cache_utilization")
    return spans.agg(
        F.count("*").alias("total_rows"),
        *[
            empty(c)
            for c in ("tenant_id", "trace_id", "span_id", "status_class", "service_name", "model")
        ],
        F.count_if(F.col("span_kind") == "unspecified").alias("no_span_kind"),
        F.count_if(F.col("ts") < F.lit("2020-01-01").cast("timestamp")).alias("before_2020"),
        F.count_if(F.col("ts") > now + F.expr("INTERVAL 1 DAY")).alias("in_the_future"),
        F.count_if(F.col("duration_ms") <= 0).alias("duration_not_positive"),
        F.count_if(F.col("duration_ms") > 600000).alias("duration_over_10_min"),
        F.count_if(chat).alias("chat_rows"),
        F.count_if(chat & (F.col("input_tokens") > 0)).alias("chat_with_tokens"),
        F.count_if(chat & (kv > 0) & (kv <= 1)).alias("chat_with_kv_cache"),
        F.count_if(chat & (F.col("ttft_ms") > 0)).alias("chat_with_ttft"),
    )


def attribute_counts(spans: DataFrame) -> DataFrame:
    """How many attributes the open map holds per span."""
    size = F.size("attributes")
    return spans.agg(
        F.count("*").alias("total_rows"),
        F.avg(size).alias("avg_attributes"),
        F.min(size).alias("min_attributes"),
        F.max(size).alias("max_attributes"),
    )


def shared_traces(spans: DataFrame) -> DataFrame:
    """``(day, traces)``: traces with both failed and good spans, for days with spans of both kinds.

    Exact at any size; ``sketches.shared_distinct`` estimates the same from two stored states.
    """
    failed = F.col("status_class") != "ok"
    per_trace = spans.groupBy(F.date_trunc("day", "ts").alias("day"), "trace_id").agg(
        F.bool_or(failed).alias("bad"), F.bool_or(~failed).alias("good")
    )
    return (
        per_trace.groupBy("day")
        .agg(
            F.count_if(F.col("bad") & F.col("good")).alias("traces"),
            F.bool_or("bad").alias("__bad"),
            F.bool_or("good").alias("__good"),
        )
        .filter(F.col("__bad") & F.col("__good"))
        .select("day", "traces")
    )


def sketch_accuracy(
    spans: DataFrame, by: list[str], column: str = "ttft_ms", p: float = 0.95
) -> DataFrame:
    """Sketched against exact quantile of a measure per group, with the relative error."""
    seen = spans.select(*by, measured(F.col(column)).alias("v")).filter(F.col("v").isNotNull())
    sketched = seen.groupBy(*by).agg(
        F.count("*").alias("n"),
        K.read_quantile(K.bucket_counts(K.quantile_state(F.col("v"))), p).alias("sketched"),
    )
    both = with_quantiles(sketched, seen, by, F.col("v"), {"exact": p})
    error = F.abs(F.col("sketched") - F.col("exact")) / F.col("exact")
    return both.select(*by, "n", "exact", "sketched", error.alias("relative_error"))

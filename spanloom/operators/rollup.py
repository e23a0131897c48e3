"""Minute and hour rollups held as mergeable states.

A state row carries partial aggregates, never final values: rows of the same key
written by different batches merge to the same result in any order, so late
spans only add another row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions import scalars as S
from spanloom.functions import sketches as K
from spanloom.operators.guard import guard_dimensions
from spanloom.registry import Registry
from spanloom.schema import DIMENSION_COLUMNS

MINUTE = "ts_minute"
HOUR = "ts_hour"

SUM_STATES = (
    "spans",
    "input_tokens",
    "output_tokens",
    "cached_tokens",
    "itl_sum",
    "itl_cnt",
    "queue_time_sum",
    "queue_time_cnt",
    "kv_cache_sum",
    "kv_cache_cnt",
    "errors",
)
QUANTILE_STATES = ("ttft", "duration")


def initial_states() -> list[Column]:
    def total(column: str, name: str) -> Column:
        return F.sum(F.col(column).cast("bigint")).alias(name)

    def average(column: str, name: str) -> list[Column]:
        seen = S.measured(F.col(column))
        return [
            F.coalesce(F.sum(seen), F.lit(0.0)).alias(f"{name}_sum"),
            F.count(seen).alias(f"{name}_cnt"),
        ]

    return [
        F.count("*").alias("spans"),
        K.distinct_state(F.col("trace_id")).alias("traces"),
        total("input_tokens", "input_tokens"),
        total("output_tokens", "output_tokens"),
        total("cached_prompt_tokens", "cached_tokens"),
        K.quantile_state(S.measured(F.col("ttft_ms"))).alias("ttft"),
        K.quantile_state(S.measured(F.col("duration_ms"))).alias("duration"),
        *average("itl_ms", "itl"),
        *average("queue_time_ms", "queue_time"),
        *average("kv_cache_utilization", "kv_cache"),
        F.max(F.col("kv_cache_utilization").cast("double")).alias("kv_cache_max"),
        F.count_if(F.col("__failed")).alias("errors"),
    ]


def _merged_states(without: Sequence[str] = ()) -> list[Column]:
    return [
        *[F.sum(c).alias(c) for c in SUM_STATES],
        K.merge_distinct_states(F.col("traces")).alias("traces"),
        *[K.merge_quantile_states(F.col(c)).alias(c) for c in QUANTILE_STATES if c not in without],
        F.max("kv_cache_max").alias("kv_cache_max"),
    ]


def rollup_1m(spans: DataFrame, allowlist: DataFrame, registry: Registry) -> DataFrame:
    """Guard the dimensions and aggregate to one state row per minute and dimension values."""
    # Failure is judged on the span's own status, before the guard rewrites it.
    marked = spans.withColumn("__failed", F.col("status_class") != "ok")
    guarded = guard_dimensions(marked, allowlist, registry)
    return guarded.groupBy(S.minute_of(F.col("ts")).alias(MINUTE), *registry.columns).agg(
        *initial_states()
    )


def rollup_1h(states_1m: DataFrame, dimensions: Sequence[str] = DIMENSION_COLUMNS) -> DataFrame:
    """Merge minute states to hours. The dimensions are already guarded."""
    return states_1m.groupBy(S.hour_of(F.col(MINUTE)).alias(HOUR), *dimensions).agg(
        *_merged_states()
    )


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge state rows of equal keys into one, still as states."""
    return states.groupBy(*keys).agg(*_merged_states())


def finalize(
    states: DataFrame, by: Sequence[str | Column] = (), extra: Sequence[Column] = ()
) -> DataFrame:
    """Turn states into values per group; ``extra`` adds aggregates of plain columns.

    Every figure a reader may want is declared; those not selected afterwards
    are pruned from the aggregate, sketches included.
    """
    if by:
        merged = states.groupBy(*by).agg(*extra, *_merged_states())
    else:
        # One row even without states, in which case there is nothing to merge.
        counted = states.groupBy(F.lit(0).alias("__all")).agg(
            *[K.merge_quantile_states(F.col(c)).alias(c) for c in QUANTILE_STATES]
        )
        held = S.single_row(counted)
        plain = states.agg(*extra, *_merged_states(without=QUANTILE_STATES))
        merged = plain.withColumns({c: held[c] for c in QUANTILE_STATES})
    keys = merged.columns[: len(by) + len(extra)]
    merged = merged.withColumns({c: K.bucket_counts(F.col(c)) for c in QUANTILE_STATES})
    zero = F.lit(0).cast("bigint")

    def count(c: str) -> Column:
        return F.coalesce(F.col(c), zero)

    def quantiles(c: str) -> list[Column]:
        return [
            K.read_quantile(F.col(c), p).alias(f"{c}_p{int(p * 100)}") for p in (0.5, 0.95, 0.99)
        ]

    return merged.select(
        *keys,
        *[
            count(c).alias(c)
            for c in ("spans", "input_tokens", "output_tokens", "cached_tokens", "errors")
        ],
        K.read_distinct(F.col("traces")).alias("traces"),
        *quantiles("ttft"),
        *quantiles("duration"),
        *[
            S.ratio(F.col(f"{c}_sum"), F.col(f"{c}_cnt")).alias(f"{c}_avg")
            for c in ("itl", "queue_time", "kv_cache")
        ],
        "kv_cache_max",
        S.ratio(count("errors"), count("spans")).alias("error_rate"),
    )


def coverage(spans: DataFrame, states: DataFrame) -> DataFrame:
    """Raw rows against rolled-up spans as totals: one row."""
    raw = spans.agg(
        F.min("ts").alias("raw_min"), F.max("ts").alias("raw_max"), F.count("*").alias("raw_rows")
    )
    rolled = S.single_row(
        states.agg(
            F.min(MINUTE).alias("rollup_min"),
            F.max(MINUTE).alias("rollup_max"),
            F.coalesce(F.sum("spans"), F.lit(0)).alias("rollup_spans"),
        )
    )
    missing = F.greatest(F.lit(0), F.col("raw_rows") - F.col("rollup_spans")).cast("bigint")
    return raw.select(
        "*", *[rolled[c].alias(c) for c in ("rollup_min", "rollup_max", "rollup_spans")]
    ).select("*", missing.alias("missing_spans"), (missing > 0).alias("needs_backfill"))


def coverage_by_minute(spans: DataFrame, states: DataFrame) -> DataFrame:
    """Minutes in which raw rows and rolled-up spans differ.

    The two tables keep their rows for different times, so totals can hide a
    gap. Only minutes both tables still hold are compared.
    """
    raw = spans.groupBy(S.minute_of(F.col("ts")).alias(MINUTE)).agg(
        F.count("*").alias("raw_rows")
    )
    rolled = states.groupBy(MINUTE).agg(F.sum("spans").alias("rollup_spans"))
    # The later of the two starts.
    start = F.greatest(
        S.single_row(spans.agg(S.minute_of(F.min("ts")).alias("at")))["at"],
        S.single_row(states.agg(F.min(MINUTE).alias("at")))["at"],
    )
    zero = F.lit(0).cast("bigint")
    return (
        raw.join(rolled, MINUTE, "full")
        .filter(F.col(MINUTE) >= start)
        .select(
            MINUTE,
            F.coalesce("raw_rows", zero).alias("raw_rows"),
            F.coalesce("rollup_spans", zero).alias("rollup_spans"),
        )
        .withColumn(
            "missing_spans", F.greatest(zero, F.col("raw_rows") - F.col("rollup_spans"))
        )
        .filter(F.col("raw_rows") != F.col("rollup_spans"))
    )

"""The live summary: is data flowing, how much, and from whom."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.scalars import instant, single_row
from spanloom.operators.health import dropped, latest_sample
from spanloom.operators.rollup import MINUTE
from spanloom.registry import Registry

# The rate covers a minute that ended ten seconds ago: spans arrive seconds late,
# and the newest seconds would look like a drop (fixed values).
RATE_WINDOW_S = 60
RATE_LAG_S = 10


def headline(
    spans: DataFrame, states: DataFrame, as_of: datetime | Column, health: DataFrame | None = None
) -> DataFrame:
    """Total spans, current rate, rollup rows, lag and dropped spans.

    The total comes from the minute states, the rate from the raw spans of its minute
    alone. Lag and drops are null while no health sample exists.
    """
    end = instant(as_of) - F.expr(f"INTERVAL {RATE_LAG_S} SECONDS")
    start = instant(as_of) - F.expr(f"INTERVAL {RATE_WINDOW_S + RATE_LAG_S} SECONDS")
    recent = spans.filter((F.col("ts") >= start) & (F.col("ts") < end))
    if "dt" in spans.columns:
        recent = recent.filter((F.col("dt") >= F.to_date(start)) & (F.col("dt") <= F.to_date(end)))
    rate = single_row(recent.agg(F.count("*").alias("n")))
    rolled = states.agg(
        F.coalesce(F.sum("spans"), F.lit(0)).alias("total_spans"), F.count("*").alias("rollup_rows")
    )
    unknown = F.lit(None).cast("bigint")
    lag, lost = unknown, unknown
    if health is not None:
        sample = latest_sample(health).select("total_lag", dropped().alias("dropped"))
        newest = single_row(sample.agg(F.max("total_lag").alias("lag"), F.max("dropped").alias("dropped")))
        lag, lost = newest["lag"], newest["dropped"]
    return rolled.select(
        "total_spans",
        F.round(rate["n"] / RATE_WINDOW_S).cast("bigint").alias("spans_per_sec"),
        "rollup_rows",
        lag.alias("lag"),
        lost.alias("dropped_spans"),
    )


def spans_per_minute(states: DataFrame, as_of: datetime | Column, minutes: int = 15) -> DataFrame:
    """Spans of each of the last minutes, with the minute in Unix seconds."""
    since = instant(as_of) - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    recent = states.filter((F.col(MINUTE) >= since) & (F.col(MINUTE) <= instant(as_of)))
    return (
        recent.groupBy(F.unix_timestamp(MINUTE).alias("t"))
        .agg(F.sum("spans").alias("n"))
        .orderBy("t")
    )


def tenant_shares(states: DataFrame, registry: Registry, top: int = 10) -> DataFrame:
    """The busiest tenants by name, then all other spans under the ``other`` sentinel."""
    other = registry.other_bucket
    totals = states.groupBy(F.col("tenant_id").alias("name")).agg(F.sum("spans").alias("n"))
    named = (
        totals.filter(F.col("name") != other).orderBy(F.desc("n"), "name").limit(top)
    )
    everything = states.agg(F.coalesce(F.sum("spans"), F.lit(0)).alias("n"))
    shown = single_row(named.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
    rest = everything.select(
        F.lit(other).alias("name"), (F.col("n") - shown["n"]).alias("n"), F.lit(1).alias("last")
    )
    return (
        named.withColumn("last", F.lit(0))
        .unionByName(rest)
        .orderBy("last", F.desc("n"), "name")
        .select("name", "n")
    )

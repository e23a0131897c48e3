"""Read-back checks: what landed, how it is skewed, and whether the rollups agree with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.quantiles import with_quantiles
from spanloom.functions.scalars import ratio, single_row
from spanloom.operators.dedup import duplication_report


def landed(
    spans: DataFrame, states: DataFrame, dead: DataFrame, lake: DataFrame
) -> DataFrame:
    """One row: raw figures, rollup size and reduction, dead letters, lake duplication."""
    # The distinct counts copy their input once each, so rows are counted per
    # tenant and trace first.
    per_trace = spans.groupBy("tenant_id", "trace_id").agg(F.count("*").alias("n"))
    raw = per_trace.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("spans"),
        F.count_distinct("tenant_id").alias("tenants"),
        F.count_distinct("trace_id").alias("traces"),
    )
    raw = with_quantiles(raw, spans, [], F.col("ttft_ms"), {"p": 0.95})
    rolled = single_row(
        states.agg(
            F.coalesce(F.sum("spans"), F.lit(0)).alias("spans"), F.count("*").alias("rows")
        )
    )
    errors = single_row(dead.agg(F.count("*").alias("n")))
    copies = single_row(duplication_report(lake))
    return raw.select(
        "spans",
        "tenants",
        "traces",
        F.round("p", 1).alias("ttft_p95"),
        rolled["spans"].alias("rollup_spans"),
        rolled["rows"].alias("rollup_rows"),
        ratio(F.col("spans"), rolled["rows"]).alias("reduction"),
        errors["n"].alias("dead_letters"),
        copies["rows"].alias("lake_rows"),
        copies["duplicates"].alias("lake_duplicates"),
        copies["duplicate_share"].alias("lake_duplicate_share"),
    )


def latency_by_model(spans: DataFrame, more_than: int = 100) -> DataFrame:
    """95th percentile of chat latency of the models with enough spans."""
    chat = spans.filter((F.col("operation") == "chat") & (F.col("model") != ""))
    counted = chat.groupBy("model").agg(F.count("*").alias("spans"))
    enough = counted.filter(F.col("spans") > more_than)
    ranked = with_quantiles(enough, chat, ["model"], F.col("ttft_ms"), {"p95": 0.95})
    return ranked.select("model", "p95").orderBy(F.desc("p95"), "model")


def tenant_skew(spans: DataFrame, top: int = 5) -> DataFrame:
    """Number of tenants and the share of spans the busiest ones hold."""
    per_tenant = spans.groupBy("tenant_id").agg(F.count("*").alias("n"))
    total = per_tenant.agg(F.count("*").alias("tenants"), F.sum("n").alias("spans"))
    best = per_tenant.orderBy(F.desc("n"), "tenant_id").limit(top)
    loudest = single_row(best.agg(F.sum("n").alias("n")))
    return total.select(
        "tenants",
        "spans",
        loudest["n"].alias("top_spans"),
        ratio(loudest["n"], F.col("spans")).alias("top_share"),
    )


def rollup_agreement(spans: DataFrame, minute: DataFrame, hour: DataFrame) -> DataFrame:
    """Totals of raw spans, minute states and hour states; the three rows must be equal."""
    raw = spans.agg(
        F.count("*").alias("spans"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.count_if(F.col("status_class") != "ok").alias("errors"),
    ).withColumn("level", F.lit("raw"))

    def states(df: DataFrame, level: str) -> DataFrame:
        return df.agg(
            *[F.sum(c).alias(c) for c in ("spans", "input_tokens", "output_tokens", "errors")]
        ).withColumn("level", F.lit(level))

    return (
        raw.unionByName(states(minute, "minute"))
        .unionByName(states(hour, "hour"))
        .select("level", "spans", "input_tokens", "output_tokens", "errors")
    )

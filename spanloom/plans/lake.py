"""Questions about data older than the hot tables, answered from the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.functions.quantiles import with_quantiles


def top_tenants_by_tokens(lake: DataFrame, limit: int = 10) -> DataFrame:
    return (
        lake.groupBy("tenant_id")
        .agg(
            F.count("*").alias("spans"),
            F.sum("output_tokens").alias("output_tokens"),
            F.round(F.avg(F.col("ttft_ms").cast("double")), 1).alias("avg_ttft_ms"),
        )
        .orderBy(F.desc("output_tokens"), "tenant_id")
        .limit(limit)
    )


def daily_volume(lake: DataFrame) -> DataFrame:
    return (
        lake.groupBy("dt")
        .agg(
            F.count("*").alias("spans"),
            F.round(F.sum("output_tokens") / 1e6, 2).alias("m_output_tokens"),
        )
        .orderBy("dt")
    )


def model_latency_by_hour(lake: DataFrame) -> DataFrame:
    """Exact 95th percentile of the time to first token of chat spans."""
    chat = lake.filter(F.col("operation") == "chat")
    keys = ["dt", "hour", "model"]
    counted = chat.groupBy(*keys).agg(F.count("*").alias("spans"))
    ranked = with_quantiles(counted, chat, keys, F.col("ttft_ms"), {"p": 0.95})
    return ranked.select(*keys, "spans", F.round("p", 1).alias("ttft_p95")).orderBy(
        "dt", "hour", F.desc("ttft_p95"), "model"
    )

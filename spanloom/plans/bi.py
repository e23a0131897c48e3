"""The report model: relabelled lake columns and the measures of its visuals."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.functions.quantiles import with_quantiles
from spanloom.functions.scalars import ratio, single_row
from spanloom.sources.lake import lake_scan

# Label of spans without a model: an agent calling a tool (fixed value).
TOOL_LABEL = "agent tool call"


def relabel(lake: DataFrame) -> DataFrame:
    """The seven columns of the report, with ``tokens`` and ``date`` added.

    A tool call has no first token; its time is blank rather than 0.
    """
    model = F.when(F.col("model") == "", TOOL_LABEL).otherwise(F.col("model"))
    return lake.select(
        "ts",
        "tenant_id",
        model.alias("model"),
        "status_class",
        F.col("input_tokens").cast("bigint").alias("input_tokens"),
        F.col("output_tokens").cast("bigint").alias("output_tokens"),
        F.when(model != TOOL_LABEL, F.col("ttft_ms").cast("double")).alias("ttft_ms"),
        (F.col("input_tokens") + F.col("output_tokens")).cast("bigint").alias("tokens"),
        # The lake's partition column, so that the date slicer prunes folders.
        (F.col("dt") if "dt" in lake.columns else F.to_date("ts")).alias("date"),
    )


def load_spans(spark: SparkSession, root: str) -> DataFrame:
    return relabel(lake_scan(spark, root))


def slice_report(
    report: DataFrame,
    model: str | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """The two slicers: one model, a closed range of dates."""
    if model is not None:
        report = report.filter(F.col("model") == model)
    if first is not None:
        report = report.filter(F.col("date") >= F.lit(first))
    if last is not None:
        report = report.filter(F.col("date") <= F.lit(last))
    return report


def cards(report: DataFrame) -> DataFrame:
    """Spans, tokens, tenants and the 95th percentile of the time to first token."""
    # Summed per tenant first: the distinct count is then a count of rows.
    per_tenant = report.groupBy("tenant_id").agg(
        F.count("*").alias("n"), F.sum("tokens").alias("t")
    )
    totals = per_tenant.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_spans"),
        F.sum("t").alias("total_tokens"),
        F.count("*").alias("tenants"),
    )
    return with_quantiles(totals, report, [], F.col("ttft_ms"), {"p95_ttft_ms": 0.95})


def tokens_by_model(report: DataFrame) -> DataFrame:
    return (
        report.groupBy("model")
        .agg(F.sum("tokens").alias("total_tokens"))
        .orderBy(F.desc("total_tokens"), "model")
    )


def top_tenants(report: DataFrame, top: int = 10) -> DataFrame:
    """Tenants of competition rank up to ``top``; ties at the border all stay.

    The border is found with a bounded sort, so no task ever ranks all tenants.
    """
    totals = report.groupBy("tenant_id").agg(F.sum("tokens").alias("total_tokens"))
    best = totals.orderBy(F.desc("total_tokens")).limit(top)
    border = single_row(best.agg(F.min("total_tokens").alias("tokens")))["tokens"]
    above = totals.filter(F.col("total_tokens") >= border)
    # At most ``top`` different totals; the rank counts the tenants above each.
    levels = above.groupBy("total_tokens").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.desc("total_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = levels.select(
        "total_tokens", (F.coalesce(F.sum("n").over(order), F.lit(0)) + 1).alias("rank")
    )
    return (
        above.join(ranks, "total_tokens")
        .select("tenant_id", "total_tokens", "rank")
        .orderBy("rank", "tenant_id")
    )


def model_table(report: DataFrame) -> DataFrame:
    counted = report.groupBy("model").agg(
        F.count("*").alias("total_spans"),
        F.count_if(F.col("status_class") != "ok").alias("errors"),
    )
    ranked = with_quantiles(counted, report, ["model"], F.col("ttft_ms"), {"p95_ttft_ms": 0.95})
    return ranked.select(
        "model",
        "total_spans",
        "p95_ttft_ms",
        ratio(F.col("errors"), F.col("total_spans")).alias("error_share"),
    ).orderBy(F.desc("total_spans"), "model")


def spans_by_status(report: DataFrame) -> DataFrame:
    return (
        report.groupBy("status_class")
        .agg(F.count("*").alias("total_spans"))
        .orderBy(F.desc("total_spans"), "status_class")
    )

"""Redelivered spans: one row per span, and how many there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_spans(
    df: DataFrame, order: Sequence[str] = ("ts",), key: str = "span_id"
) -> DataFrame:
    """The first row of each span by ``order``.

    The filter on the rank lets each task keep one row per span before the
    shuffle, so copies of a span delivered very many times never meet in one
    task. Columns that are not read afterwards are not scanned either.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("__rank", F.row_number().over(first))
        .filter(F.col("__rank") == 1)
        .drop("__rank")
    )


def duplication_report(df: DataFrame, key: str = "span_id") -> DataFrame:
    """Rows, distinct spans, surplus rows and their share: one row."""
    copies = df.groupBy(key).agg(F.count("*").alias("n"))
    totals = copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count("*").alias("distinct_spans"),
    )
    surplus = F.col("rows") - F.col("distinct_spans")
    return totals.select(
        "rows",
        "distinct_spans",
        surplus.alias("duplicates"),
        F.coalesce(F.try_divide(surplus, F.col("rows")), F.lit(0.0)).alias("duplicate_share"),
    )

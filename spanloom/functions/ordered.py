"""Previous-row access and running sums over a long ordered series.

A window without partition keys would bring the whole series into one task. The
series is cut into buckets of its order column instead; only one row per bucket
takes part in the step that carries values across bucket borders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    order: str,
    columns: Sequence[str],
    bucket: Column,
    by: Sequence[str] = (),
    prefix: str = "prev_",
) -> DataFrame:
    """Add ``prev_<column>``: the value in the row before, null in the first row.

    ``bucket`` must not decrease as ``order`` grows.
    """
    by = list(by)
    row = F.struct(*[F.col(c) for c in columns])
    cut = df.withColumn("__b", bucket).withColumn("__row", row)
    inside = cut.withColumn(
        "__prev", F.lag("__row").over(Window.partitionBy(*by, "__b").orderBy(order))
    )
    tails = cut.groupBy(*by, "__b").agg(F.max_by("__row", order).alias("__tail"))
    across = Window.partitionBy(*by).orderBy("__b") if by else Window.orderBy("__b")
    carried = tails.select(*by, "__b", F.lag("__tail").over(across).alias("__carry"))
    keys = [*by, "__b"]
    joined = inside.join(carried, keys, "left")
    previous = F.coalesce("__prev", "__carry")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[previous[c].alias(prefix + c) for c in columns],
    )


def with_running_sum(
    df: DataFrame,
    order: str,
    columns: Sequence[str],
    bucket: Column,
    by: Sequence[str] = (),
    prefix: str = "sum_",
) -> DataFrame:
    """Add ``sum_<column>``: the total of this row and all rows before it."""
    by = list(by)
    cut = df.withColumn("__b", bucket)
    frame = Window.partitionBy(*by, "__b").orderBy(order)
    frame = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = cut
    for c in columns:
        inside = inside.withColumn(f"__in_{c}", F.sum(c).over(frame))
    totals = cut.groupBy(*by, "__b").agg(*[F.sum(c).alias(f"__t_{c}") for c in columns])
    before = Window.partitionBy(*by).orderBy("__b") if by else Window.orderBy("__b")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by, "__b", *[F.sum(f"__t_{c}").over(before).alias(f"__c_{c}") for c in columns]
    )
    return inside.join(carried, [*by, "__b"], "left").select(
        *[F.col(c) for c in df.columns],
        *[
            (F.col(f"__in_{c}") + F.coalesce(F.col(f"__c_{c}"), F.lit(0))).alias(prefix + c)
            for c in columns
        ],
    )

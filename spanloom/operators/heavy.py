"""Frequent values of the raw dimensions, from counters kept beside the minute states.

The guarded states no longer know which values they folded into "other", and the top-k
allowlist needs counts over a day; both meant a scan of the raw spans. Here every minute
keeps the number of spans of each value of a dimension, one row for each. Counters add up in
any order and are exact, however many values there are and however even their shares.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.scalars import instant, minute_of
from spanloom.operators.rollup import MINUTE
from spanloom.registry import Registry

# Values of a dimension that ``heavy_values`` lists.
TRACKED = 1024


def _slots(tracked: int) -> int:
    """The power of two of which three quarters hold the values."""
    return 1 << (-(-4 * tracked // 3) - 1).bit_length()


def error_bound(spans: Column, tracked: int = TRACKED) -> Column:
    """No value beside the ``tracked`` most frequent ones of so many spans has more than this."""
    return F.ceil(spans * F.lit(3.5 / _slots(tracked)))


def value_states(spans: DataFrame, registry: Registry, tracked: int = TRACKED) -> DataFrame:
    """``(ts_minute, dimension, value, spans)``: one scan, one row for each minute and value present.

    ``tracked`` limits what is listed later, not what is counted.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(d.name).alias("dimension"), F.col(d.column).alias("value"))
            for d in registry.dimensions
        ]
    )
    present = F.filter(pairs, lambda d: d["value"] != "")
    rows = spans.select(minute_of(F.col("ts")).alias(MINUTE), F.explode(present).alias("d"))
    return rows.groupBy(MINUTE, "d.dimension", "d.value").agg(F.count("*").alias("spans"))


def merge_value_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counters of equal keys and values added up, still as states."""
    return states.groupBy(*keys, "value").agg(F.sum("spans").alias("spans"))


def _most_frequent(states: DataFrame, most: Column, tracked: int) -> DataFrame:
    """The ``most`` values of each dimension, at most ``tracked``, with the bound of its spans."""
    order = Window.partitionBy("dimension").orderBy(F.desc("spans"), "value")
    ranked = (
        merge_value_states(states, ["dimension"])
        .withColumn("__rank", F.row_number().over(order))
        # A constant limit is applied before the shuffle.
        .filter(F.col("__rank") <= tracked)
        .filter(F.col("__rank") <= most)
    )
    totals = states.groupBy("dimension").agg(error_bound(F.sum("spans"), tracked).alias("bound"))
    # One row a dimension.
    return ranked.join(F.broadcast(totals), "dimension").select("dimension", "value", "spans", "bound")


def heavy_values(states: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``(dimension, value, spans, bound)``: the most frequent values of each dimension.

    ``spans`` is the exact count. A value that is not listed has no more than ``bound`` spans.
    """
    return _most_frequent(states, F.lit(tracked), tracked)


def top_k_from_states(
    states: DataFrame, registry: Registry, as_of: datetime | Column, tracked: int = TRACKED
) -> DataFrame:
    """Most frequent values of each top-k dimension in the minutes of its trailing window.

    What ``guard.top_k_values`` finds in raw spans, with the bound of values not listed. At
    most ``tracked`` values can be asked for.
    """
    if any(d.budget > tracked for d in registry.top_k):
        raise ValueError(f"states that track {tracked} values cannot fill a larger budget")
    now = instant(as_of)
    since = F.lit(None).cast("timestamp")
    for d in registry.top_k:
        opens = now - F.expr(f"INTERVAL {int(d.top_k_window_hours)} HOURS")
        since = F.when(F.col("dimension") == d.name, opens).otherwise(since)
    recent = states.filter((F.col(MINUTE) >= since) & (F.col(MINUTE) < now))
    budget = F.lit(0)
    for d in registry.top_k:
        budget = F.when(F.col("dimension") == d.name, F.lit(d.budget)).otherwise(budget)
    return _most_frequent(recent, budget, tracked)


def unregistered_from_states(
    states: DataFrame, allowlist: DataFrame, limit: int | None = 50, tracked: int = TRACKED
) -> DataFrame:
    """Values that no allowlist row names, most frequent first, without reading raw spans."""
    # The allowlist is as small as the budgets.
    listed = F.broadcast(allowlist.select("dimension", "value").distinct())
    counted = merge_value_states(states.join(listed, ["dimension", "value"], "left_anti"), ["dimension"])
    totals = states.groupBy("dimension").agg(error_bound(F.sum("spans"), tracked).alias("bound"))
    found = counted.join(F.broadcast(totals), "dimension").select("dimension", "value", "spans", "bound")
    found = found.orderBy(F.desc("spans"), "dimension", "value")
    return found if limit is None else found.limit(limit)

"""Mergeable states for quantiles and distinct counts, with null-safe readers.

A quantile state counts values in buckets, 128 to a power of two, so a quantile read from
it is within 0.4 % of the value it stands for, whatever was merged in which order. The
buckets of equal states are equal, and any engine can count them again. Spark's frequent
items sketch is what holds the counts: it can keep more items than there are buckets, so it
never drops or estimates one, and it grows with the buckets in use.

A distinct state is a theta sketch: the smallest hashes of the values, and how far they
reach. Up to ``2**DISTINCT_LOG`` values it is exact, beyond that 1.6 % off (one sigma).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the stored states: thousandths are counted, at 2**7 buckets to a power of
# two, up to 2**40 of them (12 days in milliseconds). That makes 2 * 4352 buckets and one.
UNIT, SUB_BITS, MOST_BITS = 1000, 7, 40
CAPACITY = 16_384
DISTINCT_LOG = 12


def bucket_of(value: Column) -> Column:
    """The bucket of a number: its sign, then 8 leading bits and how far they are shifted; null for null."""
    size = F.least(F.round(F.abs(value).cast("double") * UNIT), F.lit(float(2**MOST_BITS - 1)))
    whole = F.greatest(size.cast("bigint"), F.lit(1).cast("bigint"))
    shift = F.greatest(F.length(F.bin(whole)) - (SUB_BITS + 1), F.lit(0))
    bucket = shift * (1 << SUB_BITS) + F.call_function("shiftright", whole, shift)
    return (F.signum(value.cast("double")) * bucket).cast("int")


def middle_of(bucket: Column) -> Column:
    """The number in the middle of a bucket."""
    at = F.abs(bucket).cast("bigint")
    shift = F.greatest(F.shiftright(at, SUB_BITS).cast("int") - 1, F.lit(0))
    low = F.call_function("shiftleft", at - shift * (1 << SUB_BITS), shift)
    width = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
    return F.signum(bucket.cast("double")) * (low + (width - 1) / 2) / UNIT


def quantile_state(value: Column) -> Column:
    counted = F.call_function("approx_top_k_accumulate", bucket_of(value), F.lit(CAPACITY))
    return counted["sketch"]


def _sketch(state: Column) -> Column:
    """The form in which Spark's functions take a stored state."""
    return F.struct(
        state.alias("sketch"),
        F.lit(CAPACITY).alias("maxItemsTracked"),
        F.lit(None).cast("int").alias("itemDataType"),
        F.lit("item INT").alias("itemDataTypeDDL"),
    )


def merge_quantile_states(state: Column) -> Column:
    """Needs grouping keys: Spark cannot merge no sketches at all."""
    return F.call_function("approx_top_k_combine", _sketch(state), F.lit(CAPACITY))["sketch"]


def bucket_counts(state: Column) -> Column:
    """``array<struct<bucket, n>>`` by bucket; null without a state."""
    held = F.when(state.isNotNull(), F.call_function("approx_top_k_estimate", _sketch(state), F.lit(CAPACITY)))
    held = F.filter(held, lambda e: e["item"].isNotNull())
    return F.sort_array(F.transform(held, lambda e: F.struct(e["item"].alias("bucket"), e["count"].alias("n"))))


def read_quantile(counts: Column, p: float) -> Column:
    """The middle of the bucket in which the share ``p`` is reached; null without values.

    Takes ``bucket_counts``, in a column of their own if several quantiles are read.
    """
    none = F.lit(0).cast("bigint")
    total = F.aggregate(counts, none, lambda n, e: n + e["n"])
    wanted = F.greatest(F.ceil(total * F.lit(float(p))), F.lit(1).cast("bigint"))
    start = F.struct(none.alias("seen"), F.lit(None).cast("int").alias("bucket"))

    def step(at: Column, e: Column) -> Column:
        seen = at["seen"] + e["n"]
        here = F.when(at["bucket"].isNull() & (seen >= wanted), e["bucket"]).otherwise(at["bucket"])
        return F.struct(seen.alias("seen"), here.alias("bucket"))

    return F.aggregate(counts, start, step, lambda at: middle_of(at["bucket"]))


def quantile_error() -> float:
    """Largest relative error of a quantile read from a state."""
    return 0.5 / (1 << SUB_BITS)


def written_counts(counts: Column) -> Column:
    """``bucket:n`` of every bucket, comma-joined: a state as text."""
    return F.array_join(
        F.transform(counts, lambda e: F.concat_ws(":", e["bucket"].cast("string"), e["n"].cast("string"))), ","
    )


def distinct_state(value: Column) -> Column:
    return F.theta_sketch_agg(value, F.lit(DISTINCT_LOG))


def merge_distinct_states(state: Column) -> Column:
    return F.theta_union_agg(state, F.lit(DISTINCT_LOG))


def read_distinct(state: Column) -> Column:
    return F.theta_sketch_estimate(state)


def shared_distinct(states: Sequence[Column]) -> Column:
    """How many values all of some states have in common."""
    first, *rest = states
    for state in rest:
        first = F.theta_intersection(first, state)
    return F.theta_sketch_estimate(first)

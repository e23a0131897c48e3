"""Exact quantiles without gathering a group.

``percentile`` keeps every distinct value of a group in one task's memory and a window over
a group sorts it in one task. Here equal values are first counted together; all that follows
reads these counts, so the source is scanned once. Then each wanted rank is located from
coarse to fine: in one of 2**14 slices of each power of two, and for 64-bit values in one of
2**19 slices of the slice. Only the values of the last slices are ranked. No window ever
holds more rows than one step has slices in use, or than a last slice has different values:
2**9 floats or 2**19 doubles, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.functions.scalars import single_row

FIRST_BITS, NEXT_BITS = 14, 19
# Above the exponent of the smallest positive double, so that signs do not mix.
_OFFSET = 1080


def value_slices(v: Column, levels: int) -> list[Column]:
    """Whole numbers, coarse to fine, whose lexical order is the order of the values.

    Powers of two and differences of near numbers are exact, so no value changes sides.
    """
    exponent = F.floor(F.log2(F.abs(v)))
    sign = F.signum(v)
    # Where the logarithm falls just short of a power of two, the slice is that power's first one.
    scaled = (F.abs(v) / F.pow(F.lit(2.0), exponent) - 1) * float(1 << FIRST_BITS)
    out = [(exponent + _OFFSET) * (1 << FIRST_BITS) + F.floor(scaled)]
    for _ in range(levels):
        scaled = (scaled - F.floor(scaled)) * float(1 << NEXT_BITS)
        out.append(F.floor(scaled))
    return [F.when(v == 0, 0).otherwise(sign * s).cast("bigint") for s in out]


def _ranks(p: float, n: Column, method: str) -> list[Column]:
    """0-based ranks whose values make up the quantile."""
    if method == "cont":
        at = (n - 1) * F.lit(float(p))
        return [F.floor(at).cast("bigint"), F.ceil(at).cast("bigint")]
    if method == "disc":
        first = F.greatest(F.ceil(n * F.lit(float(p))), F.lit(1)).cast("bigint") - 1
        return [first, first]
    if method == "nearest":
        at = F.least(n - 1, F.floor(n * F.lit(float(p))).cast("bigint"))
        return [at, at]
    raise ValueError(f"unknown quantile method {method!r}")


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: Column,
    quantiles: dict[str, float],
    method: str = "cont",
) -> DataFrame:
    """Quantiles of ``value`` per group, one column per entry of ``quantiles``.

    Nulls and NaN are ignored; a group without values is absent from the result, and the
    ungrouped result of no values is one row of nulls. Methods:
    ``cont`` interpolates, ``disc`` takes the first value whose cumulative share
    reaches p, ``nearest`` takes position ``int(n * p)``.
    """
    names = list(by)
    keys = [f"__k{i}" for i in range(len(names))]
    source = df.select(*[F.col(c).alias(k) for c, k in zip(names, keys)], value.alias("__v"))
    levels = 0 if isinstance(source.schema["__v"].dataType, T.FloatType) else 1
    digits = [f"__b{i}" for i in range(levels + 1)]
    # Adding 0.0 turns -0.0 into 0.0, which sorts the same as it does elsewhere.
    counted = (
        source.filter(F.col("__v").isNotNull() & ~F.isnan("__v"))
        .select(*keys, (F.col("__v").cast("double") + F.lit(0.0)).alias("__v"))
        .groupBy(*keys, "__v")
        .agg(F.count("*").alias("__c"))
        .withColumns(dict(zip(digits, value_slices(F.col("__v"), levels))))
    )

    def wanted(n: Column) -> Column:
        return F.array(
            *[
                F.struct(F.lit(i).alias("q"), F.lit(side).alias("side"), rank.alias("r"))
                for i, p in enumerate(quantiles.values())
                for side, rank in enumerate(_ranks(p, n, method))
            ]
        )

    def held(low: Column, count: Column) -> Column:
        return F.filter("__w", lambda w: (w["r"] >= low) & (w["r"] < low + count))

    def near(targets: DataFrame, at: list[str]) -> DataFrame:
        """Counted values in the targets' slices. Null is a group of its own, as in any aggregate."""
        right = targets.select(*[F.col(k).alias(f"__t{k}") for k in at], "__lo", "__n", "__w")
        if not keys:
            # At most two rows for each quantile.
            right = F.broadcast(right)
        return counted.join(right, [F.col(k).eqNullSafe(F.col(f"__t{k}")) for k in at])

    targets = None
    for depth, digit in enumerate(digits):
        at = [*keys, *digits[:depth]]
        if targets is None:
            sums = counted.groupBy(*at, digit).agg(F.sum("__c").alias("__m"))
            whole = Window.partitionBy(*at) if at else Window.partitionBy(F.lit(0))
            sums = sums.withColumns({"__n": F.sum("__m").over(whole), "__lo": F.lit(0).cast("bigint")})
            sums = sums.withColumn("__w", wanted(F.col("__n")))
        else:
            sums = near(targets, at).groupBy(*at, digit).agg(
                F.sum("__c").alias("__m"),
                *[F.first(c).alias(c) for c in ("__lo", "__n", "__w")],
            )
            whole = Window.partitionBy(*at)
        before = whole.orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        low = F.col("__lo") + F.coalesce(F.sum("__m").over(before), F.lit(0))
        targets = (
            sums.withColumn("__at", low)
            .withColumn("__w", held(F.col("__at"), F.col("__m")))
            .filter(F.size("__w") > 0)
            .select(*at, digit, F.col("__at").alias("__lo"), "__n", "__w")
        )
    last = [*keys, *digits]
    inside = Window.partitionBy(*last).orderBy("__v")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        near(targets, last)
        .withColumn("__end", F.col("__lo") + F.sum("__c").over(inside))
        .withColumn("__w", held(F.col("__end") - F.col("__c"), F.col("__c")))
        .filter(F.size("__w") > 0)
        .select(*keys, "__n", "__v", F.explode("__w").alias("__w"))
    )

    def at(i: int, side: int) -> Column:
        hit = (F.col("__w.q") == i) & (F.col("__w.side") == side)
        return F.max(F.when(hit, F.col("__v")))

    aggregated = ranked.groupBy(*keys).agg(
        F.max("__n").alias("__n"),
        *[at(i, side).alias(f"__q{i}_{side}") for i in range(len(quantiles)) for side in (0, 1)],
    )
    out = []
    for i, (name, p) in enumerate(quantiles.items()):
        low, high = F.col(f"__q{i}_0"), F.col(f"__q{i}_1")
        if method == "cont":
            place = (F.col("__n") - 1) * F.lit(float(p))
            out.append((low + (high - low) * (place - F.floor(place))).alias(name))
        else:
            out.append(low.alias(name))
    return aggregated.select(*[F.col(k).alias(c) for c, k in zip(names, keys)], *out)


def with_quantiles(
    aggregated: DataFrame,
    df: DataFrame,
    by: Sequence[str],
    value: Column,
    quantiles: dict[str, float],
    method: str = "cont",
) -> DataFrame:
    """Add exact quantile columns to a result that has one row per group of ``by``."""
    found = exact_quantiles(df, by, value, quantiles, method)
    if not by:
        row = single_row(found)
        return aggregated.select("*", *[row[c].alias(c) for c in quantiles])
    renamed = [F.col(c).alias(f"__r{i}") for i, c in enumerate(by)]
    right = found.select(*renamed, *quantiles)
    match = [aggregated[c].eqNullSafe(F.col(f"__r{i}")) for i, c in enumerate(by)]
    joined = aggregated.join(right, match, "left")
    return joined.drop(*[f"__r{i}" for i in range(len(by))])

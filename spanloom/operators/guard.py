"""The cardinality guard: allowlist construction, enforcement and audit."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.functions.scalars import instant, single_row
from spanloom.registry import Registry, registry_df, static_values


def top_k_values(spans: DataFrame, registry: Registry, as_of: datetime | Column) -> DataFrame:
    """Most frequent values of each top-k dimension in its trailing window.

    Ties are broken by value, so the result is the same on every run.
    """
    now = instant(as_of)
    parts = []
    for d in registry.top_k:
        since = now - F.expr(f"INTERVAL {int(d.top_k_window_hours)} HOURS")
        ranked = (
            spans.filter((F.col("ts") > since) & (F.col("ts") <= now) & (F.col(d.column) != ""))
            .groupBy(F.col(d.column).alias("value"))
            .agg(F.count("*").alias("spans"))
            .orderBy(F.desc("spans"), "value")
            .limit(d.budget)
        )
        parts.append(ranked.select(F.lit(d.name).alias("dimension"), "value", "spans"))
    if not parts:
        raise ValueError("the registry has no top_k dimension")
    return reduce(DataFrame.unionByName, parts)


def build_allowlist(
    spans: DataFrame, registry: Registry, as_of: datetime | Column
) -> DataFrame:
    """Enumerated values and the current top-k values: ``(dimension, value, updated_at)``.

    The result replaces the previous allowlist. Adding to it would let a top-k
    dimension outgrow its budget over time.
    """
    rows = static_values(spans.sparkSession, registry)
    if registry.top_k:
        rows = rows.unionByName(top_k_values(spans, registry, as_of).select("dimension", "value"))
    return rows.withColumn("updated_at", instant(as_of))


def guard_dimensions(spans: DataFrame, allowlist: DataFrame, registry: Registry) -> DataFrame:
    """Rewrite every dimension: absent -> none, registered -> itself, anything else -> other.

    Both lookups are bounded by the budgets. The few values of the static
    dimensions are read as arrays by a scalar subquery; a top-k dimension, which
    may list hundreds of values, is looked up by a hash join.
    """
    named = F.col("dimension")
    static, top_k = registry.static, registry.top_k
    out, registered = spans, {}
    if static:
        lists = (
            allowlist.filter(named.isin(*[d.name for d in static]))
            .groupBy()
            .agg(
                *[
                    F.collect_set(F.when(named == d.name, F.col("value"))).alias(f"__in_{d.column}")
                    for d in static
                ]
            )
        )
        row = single_row(lists)
        for d in static:
            registered[d.column] = F.array_contains(row[f"__in_{d.column}"], F.col(d.column))
    for d in top_k:
        # A value listed twice must not double the spans that carry it.
        known = (
            allowlist.filter(named == d.name)
            .select(F.col("value").alias(f"__in_{d.column}"))
            .distinct()
        )
        out = out.join(known, F.col(d.column) == F.col(f"__in_{d.column}"), "left")
        registered[d.column] = F.col(f"__in_{d.column}").isNotNull()
    return out.select(
        *[
            F.when(F.col(c) == "", registry.none_bucket)
            .when(registered[c], F.col(c))
            .otherwise(registry.other_bucket)
            .alias(c)
            if c in registered
            else F.col(c)
            for c in spans.columns
        ]
    )


def _long_form(df: DataFrame, registry: Registry, *carry: Column) -> DataFrame:
    """One row per input row and dimension, from a single scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(d.name).alias("dimension"), F.col(d.column).alias("value"))
            for d in registry.dimensions
        ]
    )
    return df.select(*carry, F.explode(pairs).alias("__d")).select(
        *[F.col(c) for c in df.select(*carry).columns], "__d.dimension", "__d.value"
    )


def unregistered_values(
    spans: DataFrame, allowlist: DataFrame, registry: Registry, limit: int | None = 50
) -> DataFrame:
    """Values present in the raw spans that no allowlist row names, most frequent first."""
    # Only spans that the guard would change are taken apart, and only their counts move on.
    guarded = guard_dimensions(
        spans.select(*[F.col(c) for c in registry.columns], *[F.col(c).alias(f"__raw_{c}") for c in registry.columns]),
        allowlist,
        registry,
    )
    hits = F.filter(
        F.array(
            *[
                F.when(
                    F.col(d.column) == registry.other_bucket,
                    F.struct(F.lit(d.name).alias("dimension"), F.col(f"__raw_{d.column}").alias("value")),
                )
                for d in registry.dimensions
            ]
        ),
        lambda hit: hit.isNotNull(),
    )
    counted = (
        guarded.select(F.explode(hits).alias("hit"))
        .groupBy("hit.dimension", "hit.value")
        .agg(F.count("*").alias("spans"))
        .orderBy(F.desc("spans"), "dimension", "value")
    )
    return counted if limit is None else counted.limit(limit)


def cardinality_status(states: DataFrame, allowlist: DataFrame, registry: Registry) -> DataFrame:
    """Observed cardinality against budget, one row per dimension.

    Counts rollup rows. A guarded column has at most budget + 2 values, so the
    rows are counted per value first and nothing needs a distinct pass.
    """
    value = F.col("value")
    per_value = (
        _long_form(states, registry).groupBy("dimension", "value").agg(F.count("*").alias("n"))
    )
    observed = per_value.groupBy("dimension").agg(
        F.count("*").alias("observed_distinct"),
        F.sum(F.when(value == registry.other_bucket, F.col("n")).otherwise(0)).alias(
            "other_bucket_rows"
        ),
        F.sum(F.when(value == registry.none_bucket, F.col("n")).otherwise(0)).alias(
            "none_bucket_rows"
        ),
        F.sum("n").alias("total_rows"),
    )
    listed = allowlist.groupBy("dimension").agg(F.count("*").alias("allowlisted"))
    zero = F.lit(0).cast("bigint")
    counts = ["allowlisted", "observed_distinct", "other_bucket_rows", "none_bucket_rows",
              "total_rows"]
    return (
        registry_df(states.sparkSession, registry)
        .join(observed, "dimension", "left")
        .join(listed, "dimension", "left")
        .select(
            "dimension",
            "budget",
            *[F.coalesce(F.col(c), zero).alias(c) for c in counts],
        )
        .select(
            "*",
            (F.col("budget") - F.col("allowlisted")).alias("headroom"),
            F.coalesce(
                F.try_divide(F.col("other_bucket_rows"), F.col("total_rows")), F.lit(0.0)
            ).alias("other_share"),
            F.coalesce(
                F.try_divide(F.col("none_bucket_rows"), F.col("total_rows")), F.lit(0.0)
            ).alias("none_share"),
            (F.col("observed_distinct") <= F.col("budget") + 2).alias("within_budget"),
        )
    )


def bucket_breakdown(states: DataFrame, registry: Registry) -> DataFrame:
    """Registered, unregistered and absent spans per dimension, as separate counts."""
    value = F.col("value")
    named = ~value.isin(*registry.sentinels)
    per_value = (
        _long_form(states, registry, F.col("spans"))
        .groupBy("dimension", "value")
        .agg(F.sum("spans").alias("n"))
    )
    n = F.col("n")
    counted = per_value.groupBy("dimension").agg(
        F.sum(F.when(named, n).otherwise(0)).alias("registered"),
        F.sum(F.when(value == registry.other_bucket, n).otherwise(0)).alias("unregistered"),
        F.sum(F.when(value == registry.none_bucket, n).otherwise(0)).alias("absent"),
        F.count_if(named).alias("distinct_values"),
    )
    budgets = registry_df(states.sparkSession, registry).select("dimension", "budget")
    zero = F.lit(0).cast("bigint")
    return (
        budgets.join(counted, "dimension", "left")
        .select(
            "dimension",
            *[
                F.coalesce(F.col(c), zero).alias(c)
                for c in ("registered", "unregistered", "absent", "distinct_values")
            ],
            "budget",
        )
        .orderBy(F.desc("unregistered"), "dimension")
    )

"""Helpers shared by the operators: private tables, words as SQL arrays, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


# Removes the shuffle files of a query when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives executors.

    The table takes the place of the shuffles that made it. Their files would otherwise stay on the
    disks until the driver collects garbage, and those of all steps add up.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, separators: str) -> Column:
    """Words between runs of separators; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components: (node, component) for every node of ``edges(src, dst)``.

    ``component`` is the smallest node reachable. Every round links each node's larger
    neighbours, then its smaller ones, to the smallest neighbour known; the number of
    rounds grows with the logarithm of a component's size. A node with very many links
    costs no task more than others, as the minimum is pre-aggregated and the rest is
    joined with adaptive skew handling. No nodes or edges reach the driver.
    """
    work = (
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .where("u <> v")
        .distinct()
    )
    work = materialize(work, "edges")
    for _ in range(rounds):
        both = work.unionAll(work.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select(
            "u", F.least("u", "low").alias("m")
        )
        # Larger neighbours go to the least of the neighbourhood.
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.where("u <> v").distinct()
        # Smaller neighbours and the node itself go to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        after = materialize(small, "edges")
        ours = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1000003).alias("h"))
        theirs = work.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1000003).alias("h")
        )
        settled = ours.first() == theirs.first()
        work = after
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = work.select(F.col("v").alias("node")).distinct()
    return work.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )


def within_bound(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

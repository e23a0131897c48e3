"""Registered queries on a log with more distinct values than a bounded state holds."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from registered import oracles, queries
from tests.test_registered import ordered

QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def larger(spark, tmp_path_factory):
    """48,000 events in two days: 12,000 traces, most of them with failed and good spans."""
    path = str(tmp_path_factory.mktemp("larger"))
    k = F.col("event_id")
    spark.range(48_000).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1704844800) + F.col("id") * 3).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3000).alias("user_id"),
    ).select(
        "*",
        F.when(k % 5 == 0, "error").when(k % 7 == 0, "signup").when(k % 3 == 0, "click").otherwise("view").alias("event_type"),
        ((k * 37 % 1000) / 10 + 0.5).alias("value"),
        F.concat(F.lit('{"k": '), k % 100, F.lit("}")).alias("props"),
    ).coalesce(1).write.parquet(os.path.join(path, "events.parquet"))
    return path


def check(spark, larger, name):
    df = QUERIES[name](spark, larger)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{larger}/events.parquet/*.parquet'")
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert ordered(df.collect(), df.columns) == ordered(cursor.fetchall(), columns)


def test_shared_traces_are_exact(spark, larger):
    check(spark, larger, "e07_shared_traces")


def test_quantiles_of_a_minute_are_observed_values(spark, larger):
    check(spark, larger, "q08_ttft_quantiles")
    seen = {r[0] for r in spark.read.parquet(f"{larger}/events.parquet").select("value").distinct().collect()}
    rows = QUERIES["q08_ttft_quantiles"](spark, larger).collect()
    assert {r[p] for r in rows for p in ("p50", "p95", "p99")} <= seen


@pytest.mark.parametrize("name", ["q02_traces", "q02_traces_streamed"])
def test_distinct_traces_are_exact(spark, larger, name):
    check(spark, larger, name)

import random

from pyspark.sql import functions as F

from spanloom.functions.ordered import with_previous, with_running_sum


def series(n=500):
    rng = random.Random(1)
    ts = sorted(rng.sample(range(100_000), n))
    return [(t, rng.randrange(1000) if rng.random() > 0.1 else None) for t in ts]


def test_previous_row_across_buckets(spark):
    rows = series()
    df = spark.createDataFrame(rows, "t long, x long").repartition(4)
    got = with_previous(df, "t", ["t", "x"], F.floor(F.col("t") / 1000)).orderBy("t").collect()
    assert [(r["t"], r["x"]) for r in got] == rows
    assert [(r["prev_t"], r["prev_x"]) for r in got] == [(None, None), *rows[:-1]]


def test_running_sum_across_buckets_and_keys(spark):
    rows = [(k, t, x or 0) for k in ("a", "b") for t, x in series(200)]
    df = spark.createDataFrame(rows, "k string, t long, x long").repartition(4)
    got = with_running_sum(df, "t", ["x"], F.floor(F.col("t") / 5000), by=["k"])
    sums = {(r["k"], r["t"]): r["sum_x"] for r in got.collect()}
    for k in ("a", "b"):
        total = 0
        for key, t, x in rows:
            if key == k:
                total += x
                assert sums[(k, t)] == total

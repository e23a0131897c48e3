import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.functions.quantiles import NEXT_BITS, exact_quantiles, value_slices, with_quantiles

PS = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}


def expected(values, p, method):
    values = sorted(values)
    n = len(values)
    if method == "cont":
        return float(np.quantile(values, p))
    if method == "disc":
        return values[max(math.ceil(n * p), 1) - 1]
    return values[min(n - 1, int(n * p))]


def data():
    rng = random.Random(7)
    groups = {
        "single": [3.25],
        "pair": [-1.0, 2.0],
        # A third of all rows is one value of one group.
        "hot": [5.0] * 900 + [rng.lognormvariate(3, 1) for _ in range(300)],
        "signs": [rng.uniform(-5, 5) for _ in range(401)] + [0.0, -0.0],
        "tiny": [rng.uniform(0, 1e-300) for _ in range(50)] + [5e-324],
        "huge": [rng.uniform(0, 1e300) for _ in range(50)],
        "ints": [float(rng.randrange(10)) for _ in range(500)],
    }
    return groups


@pytest.mark.parametrize("method", ["cont", "disc", "nearest"])
def test_against_a_sorted_list(spark, method):
    groups = data()
    rows = [(g, v) for g, values in groups.items() for v in values]
    rows += [("empty", None), ("empty", float("nan")), ("pair", None), ("pair", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    found = {r["g"]: r for r in exact_quantiles(df, ["g"], F.col("v"), PS, method).collect()}
    assert set(found) == set(groups)
    for g, values in groups.items():
        for name, p in PS.items():
            assert found[g][name] == pytest.approx(expected(values, p, method), rel=1e-9), (g, name)


def test_without_groups_and_on_nothing(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    row = exact_quantiles(df, [], F.col("v"), {"p": 0.5}).first()
    assert row["p"] == 50.0
    assert exact_quantiles(df.filter("v < 0"), [], F.col("v"), {"p": 0.5}).collect() == [(None,)]
    totals = df.filter("v < 0").agg(F.count("*").alias("n"))
    joined = with_quantiles(totals, df.filter("v < 0"), [], F.col("v"), {"p": 0.5})
    assert joined.collect() == [(0, None)]


def test_null_group_keys_match(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    totals = df.groupBy("g").agg(F.count("*").alias("n"))
    rows = with_quantiles(totals, df, ["g"], F.col("v"), {"p": 0.5}).collect()
    assert {(r["g"], r["n"], r["p"]) for r in rows} == {(None, 2, 2.0), ("a", 1, 5.0)}


def test_buckets_never_decrease_and_stay_small(spark):
    rng = random.Random(3)
    values = sorted(
        [rng.uniform(-1, 1) * 10 ** rng.randint(-30, 30) for _ in range(3000)] + [0.0]
    )
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for levels in (0, 1):
        rows = df.select("v", F.array(*value_slices(F.col("v"), levels)).alias("b")).orderBy("v").collect()
        slices = [tuple(r["b"]) for r in rows]
        assert slices == sorted(slices)
        assert all(abs(d) <= 1 << NEXT_BITS for s in slices for d in s[1:])
    # Neighbouring 32-bit floats: at most 512 share a slice.
    floats = [np.float32(123.456)]
    for _ in range(4000):
        floats.append(np.nextafter(floats[-1], np.float32(1e9)))
    df = spark.createDataFrame([(float(v),) for v in floats], "v double")
    sizes = df.groupBy(*value_slices(F.col("v"), 0)).count()
    assert sizes.agg(F.max("count")).first()[0] <= 512


def test_a_million_neighbouring_doubles(spark):
    step = 2.0**-52
    df = spark.range(1_000_000).select((F.lit(1.0) + F.col("id") * step).alias("v"))
    row = exact_quantiles(df, [], F.col("v"), {"a": 0.5, "b": 0.999}, "disc").first()
    assert row["a"] == 1.0 + 499_999 * step and row["b"] == 1.0 + 998_999 * step


def test_the_source_is_scanned_once(spark, folder):
    """All levels read the counts of one exchange."""
    path = f"{folder}/values"
    spark.range(5000).select((F.col("id") % 7).alias("g"), F.sqrt("id").alias("v")).write.parquet(path)
    found = exact_quantiles(spark.read.parquet(path), ["g"], F.col("v"), {"p50": 0.5, "p99": 0.99})
    assert found.count() == 7
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan

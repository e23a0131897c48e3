import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for results or inside.
        T.StructField("shard", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("size", T.StringType()),
        T.StructField("rep", T.StringType()),
    ]
)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty and blank texts, one very long text, ties and near copies."""
    rng = random.Random(4)
    base, other, passage = words(rng, 120), words(rng, 90), words(rng, 40)
    near = base.split()
    near[60] = "changed"
    texts = [
        None, "", "   \t\n", "one", "Two words", base, base, base.upper(), " ".join(near),
        other + "\n" + passage, passage + " " + words(rng, 50), words(rng, 60) + "\r\n" + passage,
        "aaaa " * 300, "a" * 5000, words(rng, 60_000), "nul \x00 inside " * 20, "é ü ß   　 😀 " * 15,
        passage + " " + passage,
    ]
    rows = [
        (i, t, "en", None if i % 5 == 0 else f"s{i % 3}", None if t is None else len(t), "x", "y", "z", "w")
        for i, t in enumerate(texts)
    ]
    rows.append((None, base, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

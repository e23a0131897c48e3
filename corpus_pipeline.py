"""The corpus pipeline: documents in, sharded training mix out.

Each stage takes what its predecessor kept, as a Parquet table read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm.common import materialize, table
from spanloom.llm.decontaminate import remove_contaminated
from spanloom.llm.jaccard import keep_one
from spanloom.llm.mixing import mix_documents
from spanloom.llm.quality import keep_good
from spanloom.llm.sharding import shard_documents


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of over-weighted sources repeat, at most three times."""
    return mix_documents(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

# The classifier is trained in floating point and shards follow Spark's own text hash.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

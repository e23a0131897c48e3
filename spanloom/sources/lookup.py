"""Point lookups by trace or request id: an index from ids to the files that hold them.

Layout: ``<index>/bucket=<b>/load=<name>``, with a row (hash of kind and id, day, folder, file)
for each different id of a data file, sorted by the hash. A lookup reads one bucket, where
sorted row groups skip all but the hash, and then only the data files found. The index narrows files down; rows are still compared with the id itself, so
colliding hashes or entries of replaced files cost time, never rows.

Ids of which more than ``MOST_FILES`` files hold one (an id that a broken client repeats)
are answered by a scan of the range, as a list of that many files helps nobody.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.session import literal_rows
from spanloom.sources import files

ID_COLUMNS = ("trace_id", "request_id")
# Part of the layout: another number needs a new index.
BUCKETS = 16
MOST_FILES = 1000

_INDEX = "key bigint, dt date, folder string, file string, bucket int, load string"


def _key(kind: Column, value: Column) -> Column:
    return F.xxhash64(kind, value)


def _bucket(key: Column) -> Column:
    return F.pmod(key, F.lit(BUCKETS)).cast("int")


def index_files(stored: DataFrame, folder: Column, load: str, path: str) -> None:
    """Index rows read from data files, with the folder each file lies in.

    Indexing a load again replaces its entries. Only the id columns are read.
    """
    ids = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in ID_COLUMNS])
    rows = stored.select(
        "dt", folder.alias("folder"), F.col("_metadata.file_name").alias("file"), F.explode(ids).alias("id")
    ).filter(F.col("id.value") != "")
    keyed = rows.select(_key(F.col("id.kind"), F.col("id.value")).alias("key"), "dt", "folder", "file").distinct()
    (
        keyed.select("*", _bucket(F.col("key")).alias("bucket"), F.lit(load).alias("load"))
        .hint("rebalance", F.col("bucket"))
        .sortWithinPartitions("bucket", "key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("bucket", "load")
        .parquet(path)
    )


def trim(spark: SparkSession, path: str, live: set[str]) -> None:
    """Drop the loads of which no data folder is left."""
    for folder in files.matching(spark, f"{path}/bucket=*/load=*"):
        if folder.rsplit("load=", 1)[1] not in live:
            files.delete(spark, folder)


def find_files(
    spark: SparkSession,
    path: str,
    column: str,
    values: Sequence[str],
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """``(value, folder, file, dt)``: the files that may hold rows with one of the values."""
    if column not in ID_COLUMNS:
        raise ValueError(f"{column} is not indexed, only {', '.join(ID_COLUMNS)} are")
    if not values or "" in values:
        raise ValueError("a lookup needs ids, and an absent id is not one")
    wanted = literal_rows(spark, [(v,) for v in sorted(set(values))], "value")
    wanted = wanted.withColumn("key", _key(F.lit(column), F.col("value")))
    # As many rows as ids were asked for.
    keys = [r["key"] for r in wanted.select("key").collect()]
    folders = [f"{path}/bucket={b}" for b in sorted({k % BUCKETS for k in keys})]
    present = [f for f in folders if files.exists(spark, f)]
    if not present:
        return spark.createDataFrame([], "value string, folder string, file string, dt date")
    found = spark.read.schema(_INDEX).option("basePath", path).parquet(*present).filter(F.col("key").isin(keys))
    if start is not None:
        found = found.filter(F.col("dt") >= F.lit(start.date()))
    if end is not None:
        found = found.filter(F.col("dt") <= F.lit(end.date()))
    return found.join(F.broadcast(wanted), "key").select("value", "folder", "file", "dt")

"""Text sources of pipeline health: metrics dumps and streaming progress logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_metrics_dumps(spark: SparkSession, path: str) -> DataFrame:
    """Lines of scraped metrics files as ``(scrape, line)``, one scrape per file."""
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("scrape"), F.col("value").alias("line")
    )


_PROGRESS = (
    "id string, timestamp timestamp, batchId long, numInputRows long, "
    "sources array<struct<endOffset: string, latestOffset: string>>"
)


def progress_offsets(progress: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Committed and end offsets ``(sampled_at, query_id, topic, partition, ...)`` of progress events.

    ``progress`` has one JSON progress event per row in ``value``. The source's
    offsets are objects topic -> partition -> offset.
    """
    event = F.from_json("value", _PROGRESS)
    sources = progress.select(event.alias("e")).select(
        F.col("e.timestamp").alias("sampled_at"),
        F.coalesce("e.id", F.lit("")).alias("query_id"),
        F.explode("e.sources").alias("s")
    )

    def offsets(column: str, name: str) -> DataFrame:
        topics = F.from_json(F.col(f"s.{column}"), "map<string, map<string, long>>")
        return (
            sources.select("sampled_at", "query_id", F.explode(topics).alias("topic", "partitions"))
            .select("sampled_at", "query_id", "topic", F.explode("partitions").alias("p", name))
            .select("sampled_at", "query_id", "topic", F.col("p").cast("int").alias("partition"), name)
        )

    return offsets("latestOffset", "high"), offsets("endOffset", "committed")

"""The span message stream: ``(value, topic, partition, offset)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.schema import MESSAGES

TOPIC = "otel.spans"
# Messages per micro-batch, which bounds the memory of a batch during catch-up.
MAX_OFFSETS_PER_BATCH = 2_000_000


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    max_offsets: int = MAX_OFFSETS_PER_BATCH,
    min_partitions: int | None = None,
    fail_on_data_loss: bool = True,
    **options: str,
) -> DataFrame:
    """Stream a topic. Needs the Kafka connector on the class path.

    ``min_partitions`` splits a hot topic partition over several tasks. Offsets that
    aged out before they were read stop the stream, unless ``fail_on_data_loss`` is off.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_offsets))
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.options(**options).load().select(
        F.col("value").cast("string").alias("value"), "topic", "partition", "offset"
    )


def read_message_files(
    spark: SparkSession, path: str, max_files: int | None = None
) -> DataFrame:
    """Stream messages from JSON-lines files that carry the four stream columns."""
    reader = spark.readStream.schema(MESSAGES)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return _spread(reader.json(path))


def load_messages(spark: SparkSession, path: str) -> DataFrame:
    """The same files as a batch."""
    return _spread(spark.read.schema(MESSAGES).json(path))


def _spread(messages: DataFrame) -> DataFrame:
    """A compressed file is unpacked by one task; what follows, decoding above all, is dealt to all of them."""
    return messages.repartition("partition", "offset")

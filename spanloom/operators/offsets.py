"""What a stream has consumed of its topics, and what it never saw.

Each batch enters the offset ranges it read. Offsets that no range covers were lost: they
aged out before they were read, and with ``fail_on_data_loss`` off the source skips them
without a word. The ledger has a row for each batch and slice of a topic partition, far
fewer than messages.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.scalars import instant

# Offsets are counted in slices of this length, so that a hole in one does not hide in a long range.
SLICE = 1 << 16
LOST = "offsets lost"


def consumed_ranges(messages: DataFrame, consumed_at: datetime | Column) -> DataFrame:
    """Ledger rows of a batch: first and last offset and number of messages of each slice."""
    return (
        messages.groupBy("topic", "partition", F.floor(F.col("offset") / SLICE).alias("__slice"))
        .agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count_distinct("offset").alias("messages"),
        )
        .select(instant(consumed_at).alias("consumed_at"), "topic", "partition", "first_offset", "last_offset", "messages")
    )


def offset_gaps(ledger: DataFrame) -> DataFrame:
    """``(topic, partition, from_offset, to_offset, missing)``: ranges between ledger rows that none covers.

    Ranges may overlap or come in any order; a gap is what lies before a range and after the
    furthest end of all that begin before it.
    """
    # A few rows for each batch of a topic partition.
    order = Window.partitionBy("topic", "partition").orderBy("first_offset", "last_offset")
    reached = F.max("last_offset").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = ledger.withColumn("__reached", reached).filter(F.col("first_offset") > F.col("__reached") + 1)
    return found.select(
        "topic",
        "partition",
        (F.col("__reached") + 1).alias("from_offset"),
        (F.col("first_offset") - 1).alias("to_offset"),
        (F.col("first_offset") - F.col("__reached") - 1).alias("missing"),
    )


def offset_holes(ledger: DataFrame) -> DataFrame:
    """Offsets missing inside the slices: markers of transactions, compacted or lost messages.

    A slice read by several batches is put together first.
    """
    whole = ledger.groupBy("topic", "partition", F.floor(F.col("first_offset") / SLICE).alias("__slice")).agg(
        F.min("first_offset").alias("first"), F.max("last_offset").alias("last"), F.sum("messages").alias("n")
    )
    missing = F.greatest(F.col("last") - F.col("first") + 1 - F.col("n"), F.lit(0))
    return whole.groupBy("topic", "partition").agg(F.sum(missing).alias("missing"), F.sum("n").alias("messages"))


def lost_before(batch: DataFrame, ledger: DataFrame, arrived: datetime | Column) -> DataFrame:
    """Gaps that end where a batch begins, as dead letters: what the source skipped to get there."""
    furthest = ledger.groupBy("topic", "partition").agg(F.max("last_offset").alias("reached"))
    begins = batch.groupBy("topic", "partition").agg(F.min("first_offset").alias("first"))
    skipped = begins.join(furthest, ["topic", "partition"]).filter(F.col("first") > F.col("reached") + 1)
    told = F.concat_ws("-", (F.col("reached") + 1).cast("string"), (F.col("first") - 1).cast("string"))
    return skipped.select(
        instant(arrived).alias("ingested_at"),
        "topic",
        "partition",
        (F.col("reached") + 1).alias("offset"),
        F.lit(LOST).alias("error"),
        told.alias("raw_message"),
    )

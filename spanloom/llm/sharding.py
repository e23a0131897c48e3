"""Sharding by sampled splitters: ranges of near-equal bytes, dealt to shards in order.

A document's key is (hash of its text, doc_id), so equal texts lie side by side. A sample
drawn with odds in proportion to size gives quantile splitters; rows are ranged by them;
exact range sums then place every row on one line of bytes, and the shard is the row's
place on that line. A splitter is moved to the start of its group of equal texts, unless
two or more fall into the group: such a group is overfull, and its splitters stay, so that
it is subdivided over as many ranges. A group under a tenth of a shard goes to one shard
whole; larger ones are cut where the shard ends.

Defined results: a null text counts as empty; a null doc_id sorts first; repeated rows are
rows of their own, each with a slot; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.common import materialize

LAW = "bytes"
ROW_BYTES = 16
LEAST_LONG = -(2**63)
BIN_BITS = 10


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """The rows with their private key columns."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns(
        {
            "__h": F.xxhash64(body),
            "__k": F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_LONG)),
            "__size": F.octet_length(body).cast("long") + ROW_BYTES,
        }
    )


def _splitters(keys: DataFrame, ranges: int, total: int, oversample: int) -> DataFrame:
    """Quantiles of a size-weighted sample: (h, k) rows, at most ``ranges`` of them."""
    odds = F.col("__size") * F.lit(ranges * oversample / max(total, 1))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("splitter"), "__h", "__k"), 11) / F.lit(2.0**53)
    sample = keys.where(draw < odds).select(F.col("__h").alias("h"), F.col("__k").alias("k"))
    # The sample is ranges x oversample rows on average, whatever the table's size.
    ranked = sample.withColumn("rn", F.row_number().over(Window.orderBy("h", "k")))
    quantiles = ranked.where(F.col("rn") % oversample == 0).select("h", "k").distinct()
    in_group = Window.partitionBy("h").orderBy("k")
    # The first splitter of a group moves to the group's start.
    return quantiles.withColumn("first", F.row_number().over(in_group) == 1).select(
        "h", F.when(F.col("first"), F.lit(LEAST_LONG)).otherwise(F.col("k")).alias("k")
    )


def _bin(h: Column) -> Column:
    """High bits of the hash, in the hash's order."""
    return F.shiftright(h, 64 - BIN_BITS)


def _with_range(rows: DataFrame, splitters: DataFrame) -> DataFrame:
    """``__range``: number of splitters at or below the row's key.

    The splitters of a row's bin come by a broadcast of one row for each of 1,024 bins.
    """
    half = 2 ** (BIN_BITS - 1)
    bins = splitters.sparkSession.range(-half, half).select(F.col("id").alias("__bin"))
    held = splitters.groupBy(_bin(F.col("h")).alias("__bin")).agg(
        F.array_sort(F.collect_list(F.struct("h", "k"))).alias("__cuts")
    )
    below = Window.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("__n", F.size("__cuts"))
    lookup = bins.join(held, "__bin", "left").select(
        "__bin", "__cuts", F.coalesce(F.sum("__n").over(below), F.lit(0)).alias("__base")
    )
    key = F.struct(F.col("__h").alias("h"), F.col("__k").alias("k"))
    at = F.when(F.col("__cuts").isNull(), 0).otherwise(F.size(F.filter("__cuts", lambda cut: cut <= key)))
    return (
        rows.withColumn("__bin", _bin(F.col("__h")))
        .join(F.broadcast(lookup), "__bin", "left")
        .withColumn("__range", F.col("__base") + at)
        .drop("__bin", "__base", "__cuts")
    )


def _with_shard(
    rows: DataFrame, offsets: DataFrame, shards: int, total: int, whole_share: float
) -> DataFrame:
    """``__shard`` and ``__rank``, the row's number on the whole line."""
    line = Window.partitionBy("__range").orderBy("__h", "__k")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("__range", "__h")
    start = F.col("__from") + F.coalesce(F.sum("__size").over(before), F.lit(0))
    placed = (
        rows.join(F.broadcast(offsets), "__range")
        .withColumns({"__start": start, "__rank": F.col("__rows") + F.row_number().over(line) - 1})
        .withColumns({"__all": F.sum("__size").over(group), "__first": F.min("__start").over(group)})
    )
    whole = F.col("__all") <= F.lit(whole_share * total / shards)
    middle = F.when(whole, F.col("__first") + F.col("__all") / 2).otherwise(
        F.col("__start") + F.col("__size") / 2
    )
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(float(max(total, 1)))))
    return placed.withColumn("__shard", shard.cast("int"))


def shard_documents(
    docs: DataFrame,
    shards: int = 40,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    range_bytes: int = 16 << 30,
    ranges_per_shard: int = 8,
    oversample: int = 16,
    whole_share: float = 0.1,
) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``range_bytes`` bounds what one task sorts; ``whole_share`` is the part of a shard
    up to which a group of equal texts is never cut. Columns of these two names are replaced.
    """
    keys = materialize(
        _keyed(docs.select(text, doc_id), text, doc_id).select("__h", "__k", "__size"), "keys"
    )
    total = keys.agg(F.coalesce(F.sum("__size"), F.lit(0))).first()[0]
    ranges = max(shards * ranges_per_shard, total // range_bytes)
    splitters = materialize(_splitters(keys, ranges, total, oversample), "splitters")
    ranged = _with_range(keys, splitters)
    sums = ranged.groupBy("__range").agg(F.sum("__size").alias("b"), F.count("*").alias("n"))
    lower = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        sums.select(
            "__range",
            F.coalesce(F.sum("b").over(lower), F.lit(0)).alias("__from"),
            F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("__rows"),
        ),
        "offsets",
    )
    starts = (
        _with_shard(ranged, offsets, shards, total, whole_share)
        .groupBy("__shard")
        .agg(F.min("__rank").alias("__zero"))
    )
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    placed = _with_shard(
        _with_range(_keyed(docs.select(*kept), text, doc_id), splitters),
        offsets,
        shards,
        total,
        whole_share,
    )
    return placed.join(F.broadcast(starts), "__shard").select(
        *kept, F.col("__shard").alias("shard"), (F.col("__rank") - F.col("__zero")).alias("slot")
    )

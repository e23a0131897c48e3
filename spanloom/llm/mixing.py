"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: the words of all documents are shared out by weight; a source may take at most
``max_repeats`` times its own words, and what it cannot take goes to the others by weight.

Draw: the documents of a source lie in a random order, cut into blocks by the leading
digits of their random key. A source takes whole passes over its documents, and for the
rest of its target a leading part of the order. Documents that would overshoot are passed
over and the gap is filled with later, smaller ones, ``fill_rounds`` times.

Tree: the drawn blocks of all sources start in one node. Each level splits every node in
two equal parts by a random order of its blocks, which draws each source's quota for the
left part from the multivariate hypergeometric distribution, with exact counts. The
leaves are the output shards; each is shuffled locally by ``order_key``.

Defined results: documents with null or empty text have size 0 and are never drawn; a null
source is a source of its own, last in order; repeated rows are drawn one by one; a source
of size 0 has target 0; an empty table gives no rows. The same input gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.common import materialize, within_bound

WORD = r"[^\x20\x09-\x0D]+"
NO_SOURCE = "\U0010ffff" * 4  # sorts after any other name


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """(source, source_size, target) from rows (source, size); one row for each source.

    The level at which shares stop growing is found by one ordered pass: in order of
    ``limit / weight``, the first sources are full, the others share the rest by weight.
    All windows hold one row for each source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.coalesce("source", F.lit(NO_SOURCE)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "at")
    full = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int"))
    per = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumns({"words": F.sum("source_size").over(everything), "at": F.row_number().over(by_name) - 1})
        .withColumns(
            {"weight": weight.cast("double"), "cap": F.col("source_size").cast("double") * max_repeats}
        )
    )
    level = (F.col("words") - F.coalesce(F.sum("cap").over(full), F.lit(0.0))) / F.sum("weight").over(rest)
    per = per.withColumns({"rank": F.row_number().over(order), "level": level})
    first_open = F.min(
        F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("rank", "level"))
    ).over(everything)
    return per.withColumn("open", first_open).select(
        "source",
        "source_size",
        F.when(F.col("rank") < F.col("open.rank"), F.col("cap"))
        .otherwise(F.least("cap", F.col("open.level") * F.col("weight")))
        .alias("target"),
    )


def _taken_before(rows: DataFrame) -> DataFrame:
    """``upto``: words of the source's rows up to and with this one, in the random order.

    A source is cut into blocks; only block sums meet in one task.
    """
    sums = rows.groupBy("__s", "__block").agg(F.sum("size").alias("b"))
    lower = Window.partitionBy("__s").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "__s", "__block", F.coalesce(F.sum("b").over(lower), F.lit(0)).alias("__from")
    )
    within = (
        Window.partitionBy("__s", "__block")
        .orderBy("__u", "__key", "__copy_of")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("upto", F.sum("size").over(within))
        .join(offsets, ["__s", "__block"])
        .withColumn("upto", F.col("upto") + F.col("__from"))
        .drop("__from")
    )


def plan_mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = (5, 2, 1),
    max_repeats: int = 3,
    seed: int = 7,
    fill_rounds: int = 3,
    block_digits: int = 3,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One narrow row for each document: ``size``, ``source_size``, ``target``, ``copies``.

    ``__key`` and ``__copy_of`` name the row: a hash of all its columns, and a number
    among rows equal in all columns.
    """
    words = word_count(F.col(text))
    rows = docs.select(
        F.xxhash64(*[F.col(c) for c in docs.columns]).alias("__key"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        words.alias("size"),
    )
    alike = Window.partitionBy("doc_id", "__key").orderBy("doc_id")
    rows = rows.withColumn("__copy_of", F.row_number().over(alike))
    rows = rows.withColumn(
        "__u",
        F.md5(
            F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                        F.col("__copy_of").cast("string"))
        ),
    )
    rows = materialize(rows.withColumn("__s", F.coalesce("source", F.lit(NO_SOURCE))), "rows")
    targets = materialize(source_targets(rows, weights, max_repeats), "targets").withColumn(
        "__s", F.coalesce("source", F.lit(NO_SOURCE))
    )
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.join(within_bound(targets.drop("source")), "__s").withColumns(
        {
            "__block": F.substring("__u", 1, block_digits),
            "__passes": passes.cast("int"),
            "__extra": F.lit(False),
        }
    )
    rows = materialize(rows.withColumn("__gap", F.col("target") - F.col("__passes") * F.col("source_size")), "rows")
    for _ in range(fill_rounds):
        fits = ~F.col("__extra") & (F.col("size") > 0) & (F.col("size") <= F.col("__gap"))
        open_ = _taken_before(rows.where(fits))
        drawn = open_.where(F.col("upto") <= F.col("__gap")).drop("upto").withColumn("__extra", F.lit(True))
        drawn = materialize(drawn, "drawn")
        used = drawn.groupBy("__s").agg(F.sum("size").alias("__used"))
        names = ["__s", "__block", "__u", "__key", "__copy_of"]
        marks = drawn.select(*names, F.lit(True).alias("__now"))
        rows = (
            rows.join(marks, names, "left")
            .withColumn("__extra", F.col("__extra") | F.coalesce("__now", F.lit(False)))
            .drop("__now")
            .join(within_bound(used), "__s", "left")
            .withColumn("__gap", F.col("__gap") - F.coalesce("__used", F.lit(0)))
            .drop("__used")
        )
        rows = materialize(rows, "rows")
    copies = F.when(F.col("size") > 0, F.col("__passes") + F.col("__extra").cast("int")).otherwise(0)
    return rows.withColumn("copies", copies)


def split_tree(units: DataFrame, shards: int, seed: int) -> DataFrame:
    """``units`` with ``shard``: node by node, a random part of exact size goes left.

    ``units`` has one row for each drawn block (__s, __block, __copy); their number is
    bounded by sources x blocks x repeats, not by the documents.
    """
    node = units.withColumns({"lo": F.lit(0), "hi": F.lit(shards)})
    for level in range(max(shards - 1, 0).bit_length()):
        draw = F.md5(F.concat_ws(":", F.lit(f"{seed}/{level}"), "__s", "__block", F.col("__copy").cast("string")))
        place = F.row_number().over(Window.partitionBy("lo").orderBy(draw, "__s", "__block", "__copy"))
        size = F.count("*").over(Window.partitionBy("lo"))
        node = node.withColumns({"n": size, "i": place, "mid": F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")})
        quota = F.floor(F.col("n") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        whole = F.col("hi") - F.col("lo") <= 1
        node = node.withColumn("left", F.col("i") <= quota).select(
            *units.columns,
            F.when(whole | F.col("left"), F.col("lo")).otherwise(F.col("mid")).alias("lo"),
            F.when(whole, F.col("hi")).when(F.col("left"), F.col("mid")).otherwise(F.col("hi")).alias("hi"),
        )
    return node.withColumnRenamed("lo", "shard").drop("hi")


def draw_mix(plan: DataFrame, shards: int = 16, seed: int = 7) -> DataFrame:
    """One row for each drawn copy of a document: plan columns, ``__copy``, ``shard``, ``order_key``."""
    rows = plan.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    units = rows.groupBy("__s", "__block", "__copy").agg(F.count("*").alias("n")).drop("n")
    placed = materialize(split_tree(units, shards, seed), "units")
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}/order"), "__u", F.col("__copy").cast("string")))
    return rows.join(placed, ["__s", "__block", "__copy"]).withColumn("order_key", order)


def mix_documents(docs: DataFrame, *, shards: int = 16, seed: int = 7, **options) -> DataFrame:
    """The mix itself: ``docs`` rows, repeated as drawn, with ``shard`` and ``order_key``.

    Write each shard sorted by ``order_key``. Columns of these two names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("shard", "order_key")]
    docs = docs.select(*kept)
    draws = draw_mix(plan_mix(docs, seed=seed, **options), shards, seed)
    draws = draws.select("__key", "shard", "order_key")
    alike = Window.partitionBy("__key").orderBy("__key")
    # Rows equal in all columns are interchangeable: one stands for all draws.
    wide = docs.withColumn("__key", F.xxhash64(*[F.col(c) for c in kept]))
    wide = wide.withColumn("__n", F.row_number().over(alike)).where("__n = 1").drop("__n")
    return wide.join(draws, "__key").drop("__key")

"""Benchmark decontamination: a hash set of the test items' word windows, probed by every text.

Words are maximal runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII.
An item's windows are its runs of ``window`` consecutive words, or all its words if it has
fewer. The distinct windows, keyed by hash, are broadcast while their number is within
``broadcast_windows`` and their words within ``BROADCAST_BYTES``; beyond that the join is
shuffled, and a position travels with the words of its own window alone. Every position of
every text is probed in one pass: by the hash of its first words, where the windows are broadcast,
then by that of the whole window. A hit counts only if its words equal the window's.

Defined results: null or empty texts have no words and no hits; items without words have no
windows; equal windows of several items count for each of them; results are per doc_id:
rows that share one, or have none, are judged one by one, their counts of words and of hits
add up and their items are put together; an empty benchmark marks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.common import ascii_lower, materialize, split_words

# Everything in ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Words of a window that tell nearly all other places of a text from it.
HEAD = 3
BROADCAST_BYTES = 128 << 20


def item_words(text: Column) -> Column:
    return split_words(ascii_lower(text), SEPARATORS)


def benchmark_windows(benchmark: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """(words, n, h, items): the distinct windows, their length, hash and items."""
    cut = benchmark.select(F.col(item_id).cast("string").alias("item"), item_words(F.col(text)).alias("w"))
    cut = cut.where(F.size("w") > 0).withColumn("n", F.least(F.lit(window), F.size("w")))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    cut = cut.select("item", "n", "w", F.explode(starts).alias("at"))
    cut = cut.select("item", "n", F.slice("w", F.col("at"), F.col("n")).alias("words"))
    # An item of many copies of one window, or a window of many items, stays one row.
    return cut.groupBy("words", "n").agg(F.collect_set("item").alias("items")).withColumn(
        "h", F.xxhash64("words")
    )


def small_enough(windows: DataFrame, rows: int) -> bool:
    """Whether the windows, as rows and as bytes, can be sent to every executor."""
    size = F.sum(F.octet_length(F.array_join("words", " ")) + 64 + 16 * F.size("words"))
    held = windows.agg(F.count("*").alias("n"), F.coalesce(size, F.lit(0)).alias("b")).first()
    return held["n"] <= rows and held["b"] <= BROADCAST_BYTES


def _head(words: Column, at: Column, n: Column) -> Column:
    """Hash of the first words of the window of ``n`` words at ``at``; what it does not have is null and skipped."""
    return F.xxhash64(*[F.when(n > i, F.get(words, at + (i - 1))) for i in range(HEAD)])


def window_hits(docs: DataFrame, windows: DataFrame, *, text: str, doc_id: str, small: bool) -> DataFrame:
    """(doc_id, row, at, n, words): every place of a text where a window begins.

    ``row`` tells rows of one doc_id apart; it holds within one evaluation only.
    """
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most `window` values
    if not lengths:
        lengths = [1]

    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        item_words(F.col(text)).alias("__w"),
        F.monotonically_increasing_id().alias("row"),
    )
    cut = rows.withColumn("n", F.explode(F.lit(lengths))).where(F.size("__w") >= F.col("n"))
    starts = F.sequence(F.lit(1), F.size("__w") - F.col("n") + 1)
    places = cut.select("doc_id", "row", "n", "__w", F.explode(starts).alias("at"))
    if small:
        heads = windows.select(_head(F.col("words"), F.lit(1), F.col("n")).alias("__head")).distinct()
        here = _head(F.col("__w"), F.col("at"), F.col("n"))
        places = places.join(F.broadcast(heads), here == F.col("__head"), "left_semi")
    # A place takes its own words along: the whole text at each of its places would be its square.
    words = F.slice("__w", F.col("at"), F.col("n")).alias("words")
    probed = places.select("doc_id", "row", "at", "n", words).withColumn("h", F.xxhash64("words"))
    keys = windows.select("h", F.col("n").alias("__n"), F.col("words").alias("__words"))
    if small:
        keys = F.broadcast(keys)
    hits = probed.join(keys, "h").where((F.col("n") == F.col("__n")) & (F.col("words") == F.col("__words")))
    return hits.select("doc_id", "row", "at", "n", "words")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = 10,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    item_text: str = "text",
    broadcast_windows: int = 1_000_000,
) -> DataFrame:
    """Per document: n_words, n_hit (words inside a window), items (sorted ids), contaminated."""
    windows = materialize(benchmark_windows(benchmark, window, item_id, item_text), "windows")
    small = small_enough(windows, broadcast_windows)
    hits = materialize(window_hits(docs, windows, text=text, doc_id=doc_id, small=small), "hits")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    spans = hits.select(key.alias("__d"), "row", "at", "n").distinct()
    # Words of a span not covered by the spans before it, in one pass over a row's own hits.
    before = Window.partitionBy("__d", "row").orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max(F.col("at") + F.col("n")).over(before), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("at") + F.col("n") - F.greatest("at", seen))
    covered = spans.withColumn("fresh", fresh).groupBy("__d").agg(F.sum("fresh").alias("n_hit"))
    found = hits.select(key.alias("__d"), "words").distinct()
    items = (
        found.join(windows.select("words", "items"), "words")
        .select("__d", F.explode("items").alias("item"))
        .groupBy("__d")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    sizes = (
        # Counted as they stand: capitals do not part words.
        docs.select(F.col(doc_id).alias("doc_id"), F.size(split_words(F.col(text), SEPARATORS)).cast("long").alias("n"))
        .groupBy("doc_id")
        .agg(F.sum("n").alias("n_words"))
        .withColumn("__d", key)
    )
    return sizes.join(covered, "__d", "left").join(items, "__d", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that contain a window of an item."""
    doc_id = options.get("doc_id", "doc_id")
    found = find_contamination(docs, benchmark, **options).where("contaminated")
    bad = found.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__bad"))
    mine = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return docs.join(bad, mine == F.col("__bad"), "left_anti")

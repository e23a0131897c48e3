"""N-gram Jaccard join by prefix tree: links of 75 % overlap between sets of word shingles.

1. Shingles that occur in one document only cannot be shared; a document needs three
   quarters of its shingles to occur elsewhere (``features``).
2. Equal sets become one class. Rows and classes go by a number of their own, so documents
   that share a doc_id stay apart; doc_ids only name the components in the end.
3. Shingles are ordered, rare ones first, and two linked sets share one of their leading
   ``n - ceil(3n/4) + 1`` shingles. Classes that share one are chained to its smallest
   class; the connected parts hold every possible link.
4. Within a part, sets go into a trie with frequent shingles on top. Each set descends it
   with the overlap gathered so far, branches are shared, and a subtree is left when the
   lengths that remain cannot reach the overlap needed, or when all its sets are already
   known to be connected with the one at hand. Large parts are cut in blocks, a task for
   each two blocks, so a task's memory is bounded; tasks return spanning links only.

Defined results: words are cut at blanks, A-Z lower-cased; a text of fewer than five words
is one shingle; null and empty texts have none, and link with nothing; rows with one doc_id
are documents of their own, linked only if their texts are; a row without doc_id links like
others, names no component and has a null one itself; extra columns are ignored. Of a group
``keep_one`` keeps a single row, that of the smallest doc_id (of several such any one); rows
without doc_id come last. Its doc_ids may be of any type, those of ``near_duplicates`` are
whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import components, materialize
from spanloom.llm.features import ID_BITS, shared_features
from spanloom.llm.tokens import FOLDED_VALUE, NOT_BLANK, Prefix, Words

SHINGLE = 5
BLOCK_SETS = 1024
# Links: |x & y| / |x | y| >= 3/4, that is 7 |x & y| >= 3 (|x| + |y|).
OVERLAP, SIZES = 7, 3


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a chunk's shingles, their rows in order, and the size of each row's set."""
    words = Words(data, offsets, NOT_BLANK, FOLDED_VALUE)
    prefix = Prefix(words.hash)
    begin, count = words.offsets[:-1], np.diff(words.offsets)
    several = np.maximum(count - SHINGLE + 1, np.minimum(count, 1))
    rows = np.repeat(np.arange(len(count)), several)
    inner = np.arange(len(rows)) - np.repeat(np.cumsum(several) - several, several)
    start = begin[rows] + inner
    hashes = prefix.stretch(start, start + np.minimum(count, SHINGLE)[rows])
    key = np.sort((hashes >> np.uint64(ID_BITS) << np.uint64(ID_BITS)) | (rows & 0xFFFF).astype(np.uint64))
    # Rows of a chunk beyond 65,536 would fold together; chunks of 2 MB of such short texts are cut.
    size = np.zeros(len(count), dtype=np.int64)
    if len(count) <= 0xFFFF:
        fresh = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
        size[: len(count)] = np.bincount((fresh & np.uint64(0xFFFF)).astype(np.int64), minlength=len(count))
    else:
        pairs = np.unique(np.stack([rows.astype(np.uint64), hashes >> np.uint64(ID_BITS)]), axis=1)
        size[:] = np.bincount(pairs[0].astype(np.int64), minlength=len(count))
    return hashes, rows, size


def needed(size: int) -> int:
    """Overlap that a set needs with any partner: three quarters of it, rounded up."""
    return -(-3 * size // 4)


def _leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, rep): the shared shingles within each set's leading part."""
    for batch in batches:
        size = batch.column("size").to_numpy()
        reps = batch.column("rep").to_numpy()
        found, owners = [np.zeros(0, np.int64)], []
        for n, shared in zip(size, batch.column("shared")):
            values = np.frombuffer(shared.as_py(), dtype=np.int64)
            # Shingles of no other document come first in the order and take up places.
            found.append(values[: max(0, n - needed(n) + 1 - (n - len(values)))])
        owners = np.repeat(reps, [len(x) for x in found[1:]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(found)), pa.array(owners, pa.int64())], names=["feature", "rep"]
        )


class Forest:
    """Union-find over the sets of a task."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x


class Node:
    __slots__ = ("edge", "kids", "here", "low", "rest", "uniform")

    def __init__(self, edge: np.ndarray) -> None:
        self.edge, self.kids, self.here = edge, {}, []
        self.low, self.rest = 1 << 62, 0
        self.uniform = -1  # a set of the subtree, if all its sets were connected when last seen


class Trie:
    """Sets of ascending integers, merged where they begin alike."""

    def __init__(self, forest: Forest, vocabulary: int) -> None:
        self.root, self.forest = Node(np.zeros(0, np.int32)), forest
        self.mark = np.zeros(vocabulary + 1, dtype=np.int32)

    def insert(self, name: int, values: np.ndarray, size: int) -> None:
        node, rest = self.root, values
        while True:
            node.low = min(node.low, size)
            node.rest = max(node.rest, len(rest))
            if node.uniform >= 0 and node.uniform != name:
                node.uniform = -1
            if not len(rest):
                node.here.append(name)
                return
            child = node.kids.get(int(rest[0]))
            if child is None:
                child = Node(rest)
                child.low, child.here = size, [name]
                node.kids[int(rest[0])] = child
                return
            edge = child.edge
            k = min(len(edge), len(rest))
            differ = np.flatnonzero(edge[:k] != rest[:k])
            k = int(differ[0]) if len(differ) else k
            if k < len(edge):
                upper = Node(edge[:k])
                upper.kids[int(edge[k])] = child
                upper.low, upper.rest = child.low, child.rest + len(edge) - k
                child.edge = edge[k:]
                node.kids[int(rest[0])] = upper
                child = upper
            node, rest = child, rest[k:]

    def _uniform(self, node: Node) -> int:
        """A set of the subtree if all its sets are connected, else -1. Stays true once true."""
        if node.uniform >= 0:
            return node.uniform
        find, one = self.forest.find, -1
        for name in node.here:
            if one < 0:
                one = name
            elif find(one) != find(name):
                return -1
        for kid in node.kids.values():
            got = kid.uniform
            if got < 0:
                if kid.kids:
                    return -1
                got = self._uniform(kid)
            if got < 0 or (one >= 0 and find(one) != find(got)):
                return -1
            one = got
        node.uniform = one
        return one

    def links(self, name: int, values: np.ndarray, size: int) -> Iterator[int]:
        """Sets of the trie linked with this one, leaving out those already connected with it."""
        find, mark = self.forest.find, self.mark
        mark[values] = 1
        least_size = needed(size)
        stack = [(self.root, 0, 0)]
        order = np.sort(values)
        while stack:
            node, overlap, _ = stack.pop()
            one = self._uniform(node)
            if one >= 0 and find(one) == find(name):
                continue
            edge = node.edge
            if len(edge):
                overlap += int(mark[edge].sum())
                left = len(order) - int(np.searchsorted(order, edge[-1], side="right"))
            else:
                left = len(order)
            partner = max(node.low, least_size)
            if OVERLAP * (overlap + min(left, node.rest)) < SIZES * (size + partner):
                continue
            for other in node.here:
                yield other, overlap
            kids = node.kids
            if kids:
                far = [(kid, overlap, 0) for first, kid in kids.items() if not mark[first]]
                near = [(kid, overlap, 0) for first, kid in kids.items() if mark[first]]
                stack.extend(far)
                stack.extend(near)
        mark[values] = 0


def _join_part(part: pd.DataFrame) -> list[tuple[int, int]]:
    """Spanning links of one part: of its sets, or of its two blocks of sets."""
    sides = part["side"].to_numpy()
    reps, sizes = part["rep"].to_numpy(), part["size"].to_numpy()
    raw = [np.frombuffer(x, dtype=np.uint64) for x in part["shared"]]
    lengths = np.array([len(x) for x in raw])
    _, number, count = np.unique(np.concatenate(raw), return_inverse=True, return_counts=True)
    place = np.empty(len(count), dtype=np.int32)
    place[np.argsort(-count, kind="stable")] = np.arange(len(count), dtype=np.int32)
    flat = place[number.ravel()]
    common = count[number.ravel()] > 1
    sets, first = [], 0
    for n in lengths:
        sets.append(np.sort(flat[first : first + n][common[first : first + n]]))
        first += n
    forest = Forest(len(sets))
    trie = Trie(forest, len(count))
    links = []
    both = (sides == 1).any()
    # Sets that can hardly differ come one after the other.
    for x in sorted(range(len(sets)), key=lambda i: (sides[i], sizes[i])):
        if not both or sides[x] == 1:
            for other, overlap in trie.links(x, sets[x], int(sizes[x])):
                if OVERLAP * overlap >= SIZES * (int(sizes[x]) + int(sizes[other])):
                    a, b = forest.find(x), forest.find(other)
                    if a != b:
                        forest.up[max(a, b)] = min(a, b)
                        links.append((int(reps[x]), int(reps[other])))
        if sides[x] == 0:
            trie.insert(x, sets[x], int(sizes[x]))
    return links


def _join_group(group: pd.DataFrame) -> pd.DataFrame:
    found = [link for _, part in group.groupby("part", sort=False) for link in _join_part(part)]
    return pd.DataFrame(found, columns=["src", "dst"], dtype="int64")


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bits: int | None = None,
    block_sets: int = BLOCK_SETS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``."""
    found = shared_features(docs, shingles, doc_id=doc_id, text=text, bucket_bits=bucket_bits)
    enough = (F.col("size") > 0) & (4 * F.col("n_shared") >= 3 * F.col("size"))
    # Equal digests with all shingles shared are equal sets; others stay alone.
    whole = F.octet_length("shared") == 8 * F.col("size")
    alone = F.concat_ws("/", F.md5("shared"), F.when(~whole, F.col("row").cast("string")))
    found = materialize(
        found.withColumn("row", F.monotonically_increasing_id()).select(
            "doc_id",
            "size",
            "row",
            F.when(enough, F.col("shared")).alias("shared"),
            F.when(enough, alone).alias("class"),
        ),
        "sets",
    )
    named = found.where("class is not null")
    classes = materialize(
        named.groupBy("class").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least"), F.count("*").alias("n")),
        "classes",
    )
    # The few rows that are copies of another are taken out, so that the sets stay where they lie.
    several = classes.where("n > 1").select("class", "rep")
    copies = materialize(named.select("class", "row").join(several, "class").where("row <> rep").select("row"), "copies")
    sets = materialize(
        named.join(copies, "row", "left_anti").select(F.col("row").alias("rep"), "size", "shared"), "reps"
    )
    leading = sets.mapInArrow(_leading, "feature long, rep long")
    pivots = leading.groupBy("feature").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    chains = leading.join(pivots, "feature").where("rep <> pivot").select(
        F.col("pivot").alias("src"), F.col("rep").alias("dst")
    )
    parts = materialize(components(chains.distinct()), "parts")
    counts = parts.groupBy("component").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / block_sets).cast("int")
    groups = counts.agg(F.coalesce(F.ceil(F.sum("n") / block_sets), F.lit(1)).alias("g")).first()["g"]
    members = (
        parts.join(counts.withColumn("blocks", blocks), "component")
        .join(sets, F.col("node") == F.col("rep"))
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    )
    # Block b meets every block from itself on; of two blocks the first is side 0.
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(
            F.least("block", o).alias("i"),
            F.greatest("block", o).alias("j"),
            F.when(F.col("block") > o, 1).otherwise(0).alias("side"),
        ),
    )
    tasks = members.withColumn("pair", F.explode(pairs)).select(
        F.when(F.col("blocks") > 1, F.concat_ws("/", "component", "pair.i", "pair.j"))
        .otherwise(F.pmod(F.xxhash64("component"), F.lit(groups)).cast("string"))
        .alias("group"),
        F.col("component").alias("part"),
        "rep",
        "size",
        "shared",
        "pair.side",
    )
    links = tasks.groupBy("group").applyInPandas(_join_group, "src long, dst long")
    joined = materialize(components(links), "components")
    # Most classes are linked with no other and need no second look.
    linked = classes.join(joined, F.col("rep") == F.col("node"), "left").select("class", "least", "component")
    names = linked.where("component is not null").groupBy("component").agg(F.min("least").alias("smallest"))
    final = linked.join(names, "component", "left").select(
        F.col("class").alias("of"), F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("name")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("name")).alias("component_id")
    together = named.join(final, F.col("class") == F.col("of")).select(
        "doc_id", F.col("size").alias("n_shingles"), component
    )
    return together.unionAll(
        found.where("class is null").select(
            "doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")
        )
    )


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest id."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(docs, doc_id=row, text=text, **options)
    members = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("member"), F.col("component_id").alias("group"))
    members = materialize(members, "members")
    members = members.unionAll(members.select(F.col("group").alias("member"), "group").distinct())
    ids = docs.select(F.col(row).alias("member"), F.col(doc_id).alias("id"))
    # Null ids sort behind all others.
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "member")
    ranked = materialize(members.join(ids, "member").select("group", rank.alias("rank")), "ranked")
    kept = ranked.groupBy("group").agg(F.min("rank").alias("best"))
    copies = ranked.join(kept, "group").where("rank.member <> best.member").select(F.col("rank.member").alias(row))
    return docs.join(copies, row, "left_anti").drop(row)

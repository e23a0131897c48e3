"""Merkle manifest of a dataset by cogrouped subtree exchange.

Each row is a leaf, the SHA-256 of its fields. The leaves of a group (a source), in order of
their key, are the first level of a ternary tree: every three consecutive nodes, or what is
left of them at the end, hash to one node of the next level, until one is left. The roots
of the groups, in order of the group, are the leaves of a last tree of the same kind.

No task holds a tree. Its leaves are cut into superblocks of ``3**7``, which one call
reduces to a node; these nodes are the leaves of the next layer, and so on, so that a
thousand leaves become one in a layer and four layers hold 10**13. On the way back each
layer is cogrouped with the path of the superblock it belongs to (its outer nodes: the
siblings from the superblock's root up to the root of all): one call reduces the superblock
again, joins its inner proofs with the outer one and, on the layer of the rows, folds what
was received up to the root. A hot group only has more superblocks.

Ranks come from a range partitioning by group and key, with a row number as its last key, so
that rows repeated very often spread over tasks as well; they are written before use.

Defined results: a null field is ``-``; null keys come first, a null group is the first
group; rows that share a key are ordered by their leaf, and each is a leaf; a lone leaf is
the root of its group, as a lone group's root is the root of all; an empty table gives an
empty result; texts are hashed whole; columns that are not fields are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.llm.common import materialize

ARITY, LEVELS = 3, 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# A step of a node's path: its siblings and its place among them. Step 0 carries the roots only.
PATH = "grp string, pos long, step int, slot int, siblings array<string>, subroot string, root string"


def field(value: Column) -> Column:
    """``-`` if null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def hash_of(nodes: Iterable[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def reduce_block(nodes: list[str], whole: bool, span: int) -> list[list[str]]:
    """The levels from ``nodes`` to one node: all of a group's, or as many as a superblock has."""
    levels = [nodes]
    left = span
    while len(levels[-1]) > 1 if whole else left > 1:
        below = levels[-1]
        levels.append([hash_of(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
        left //= ARITY
    return levels


def block_paths(levels: list[list[str]]) -> list[tuple[list[int], list[list[str]]]]:
    """For each node of the lowest level its slots and siblings, upwards."""
    paths: list[tuple[list[int], list[list[str]]]] = [([], [])]
    for below in reversed(levels[:-1]):
        grown = []
        for i in range(len(below)):
            slots, siblings = paths[i // ARITY]
            low = i - i % ARITY
            grown.append(([i % ARITY, *slots], [below[low:i] + below[i + 1 : low + ARITY], *siblings]))
        paths = grown
    return paths


def fold(node: str, slots: Iterable[int], siblings: Iterable[list[str]]) -> str:
    """The root that a node and its proof lead to."""
    for slot, others in zip(slots, siblings):
        node = hash_of([*others[:slot], node, *others[slot:]])
    return node


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``pos`` and ``n``: place in their ``grp`` by ``order``, from 0, and its number of rows."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("grp").asc(), *order, F.col("__row").asc()]
    dealt = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(parts, *keys)
    numbered = dealt.sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()).drop("__row")
    numbered = materialize(numbered.withColumn("__part", F.shiftright("__at", 33)), name)
    # A row for each group of each partition.
    held = numbered.groupBy("grp", "__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__low"))
    of_group = Window.partitionBy("grp")
    before = F.sum("__n").over(of_group.orderBy("__part")) - F.col("__n")
    held = held.select("grp", "__part", "__low", before.alias("__before"), F.sum("__n").over(of_group).alias("n"))
    placed = numbered.join(held, ["grp", "__part"])
    return placed.withColumn("pos", F.col("__at") - F.col("__low") + F.col("__before")).drop(
        "__at", "__part", "__low", "__before"
    )


def _upper(span: int):
    """The node a superblock reduces to."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pos")
        n = int(group["n"].iloc[0])
        levels = reduce_block(group["digest"].tolist(), n <= span, span)
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]], "digest": levels[-1], "n": [-(-n // span)]})

    return run


def layers_of(nodes: DataFrame, span: int, least: int = 1) -> list[DataFrame]:
    """The nodes (grp, pos, digest, n) of one layer after the other, up to one node a group."""
    found = [nodes]
    while len(found) < least or (found[-1].agg(F.max("n")).first()[0] or 0) > 1:
        blocks = found[-1].select("grp", (F.col("pos") / span).cast("long").alias("block"), "pos", "digest", "n")
        above = blocks.groupBy("grp", "block").applyInPandas(
            _upper(span), "grp string, pos long, digest string, n long"
        )
        found.append(materialize(above, "layer"))
    return found


def _outer(path: pd.DataFrame) -> tuple[list[int], list[list[str]], str | None, str]:
    path = path.sort_values("step")
    steps = path[path["step"] > 0]
    siblings = [list(s) for s in steps["siblings"]]
    return [int(s) for s in steps["slot"]], siblings, path["subroot"].iloc[0], path["root"].iloc[0]


def _inner_paths(group: pd.DataFrame, path: pd.DataFrame, span: int):
    """(row, slots, siblings) of every node of a superblock up to the root of all, and the two roots."""
    group = group.sort_values("pos")
    slots, siblings, subroot, root = _outer(path)
    levels = reduce_block(group["digest"].tolist(), int(group["n"].iloc[0]) <= span, span)
    paths = [(a + slots, b + siblings) for a, b in block_paths(levels)]
    return group, paths, subroot, root


def _down(span: int):
    """Paths of the nodes of a superblock from the path of its own node."""

    def run(key: tuple, group: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        group, paths, subroot, root = _inner_paths(group, path, span)
        rows = []
        for pos, (slots, siblings) in zip(group["pos"], paths):
            rows.append((key[0], pos, 0, None, None, subroot, root))
            rows += [(key[0], pos, k, a, b, subroot, root) for k, (a, b) in enumerate(zip(slots, siblings), 1)]
        return pd.DataFrame(rows, columns=["grp", "pos", "step", "slot", "siblings", "subroot", "root"]).astype(
            {"slot": "Int32"}
        )

    return run


def _leaves(span: int):
    """Proof and folded root of the leaves of a superblock."""

    def run(key: tuple, group: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        group, paths, subroot, root = _inner_paths(group, path, span)
        received = [r if isinstance(r, str) else d for r, d in zip(group["received"], group["digest"])]
        return pd.DataFrame(
            {
                "key": group["key"].to_numpy(), "grp": key[0], "position": group["pos"].to_numpy(),
                "leaf": group["digest"].to_numpy(), "subroot": subroot, "root": root,
                "slots": [p[0] for p in paths], "proof": [p[1] for p in paths],
                "folded_root": [fold(r, *p) for r, p in zip(received, paths)],
            }
        )

    return run


def _exchange(nodes: DataFrame, paths: DataFrame, run, schema: str, span: int) -> DataFrame:
    """Cogroup the nodes of a layer with the outer nodes their superblock needs."""
    inner = nodes.withColumn("block", (F.col("pos") / span).cast("long")).groupBy("grp", "block")
    outer = paths.withColumn("block", F.col("pos")).groupBy("grp", "block")
    return inner.cogroup(outer).applyInPandas(run(span), schema)


def merkle_manifest(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    group: str = "source",
    fields: tuple[str, ...] = FIELDS,
    received: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """A row for each row of ``docs``: its leaf, roots and proof, and whether what was received holds.

    Columns: key, group, position, leaf, subroot, root, slots and proof (for each level up to
    the root of all the own place in the run and the siblings, left to right), folded_root,
    verified. ``received`` gives fields as they arrived, the others are taken as they are.
    """
    span = ARITY**levels
    arrived = {name: (received or {}).get(name, F.col(name)) for name in fields}
    leaf, got = leaf_digest(F.col(c) for c in fields), leaf_digest(arrived.values())
    # Groups in bytewise order, null first.
    name = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = docs.select(F.col(key).alias("sort_key"), name.alias("grp"), leaf.alias("digest"), got.alias("received"))
    rows = rows.withColumn("received", F.when(F.col("received") != F.col("digest"), F.col("received")))
    rows = materialize(rows, "leaves")
    placed = ranked(rows, [F.col("sort_key").asc_nulls_first(), F.col("digest").asc(), F.col("received").asc()], "ranked")
    # Keys travel as text, as pandas has no long that can be null.
    leaves = materialize(
        placed.select("grp", "pos", "digest", "n", "received", F.col("sort_key").cast("string").alias("key")), "placed"
    )
    lower = layers_of(leaves, span, least=2)
    tops = lower[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    tops = materialize(ranked(tops, [F.col("of").asc()], "roots"), "subroots")
    upper = layers_of(tops.select("grp", "pos", "digest", "n"), span)
    none = F.lit(None)
    paths = upper[-1].select(
        "grp", "pos", F.lit(0).alias("step"), none.cast("int").alias("slot"), none.cast("array<string>").alias("siblings"),
        none.cast("string").alias("subroot"), F.col("digest").alias("root"),
    )
    for nodes in reversed(upper[:-1]):
        paths = materialize(_exchange(nodes, paths, _down, PATH, span), "paths")
    # The path of a group's only node, now that it is known where the group stands.
    own = tops.select(F.col("pos"), F.col("of"), F.col("digest").alias("own"))
    paths = paths.join(own, "pos").select(
        F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), "step", "slot", "siblings", F.col("own").alias("subroot"), "root"
    )
    for nodes in reversed(lower[1:-1]):
        paths = materialize(_exchange(nodes, paths, _down, PATH, span), "paths")
    found = _exchange(
        leaves, paths, _leaves,
        "key string, grp string, position long, leaf string, subroot string, root string, slots array<int>, "
        "proof array<array<string>>, folded_root string", span,
    )
    return found.select(
        F.col("key").cast(docs.schema[key].dataType).alias(key),
        F.when(F.col("grp") != "0", F.substr("grp", F.lit(2))).cast(docs.schema[group].dataType).alias(group),
        "position", "leaf", "subroot", "root", "slots", "proof", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

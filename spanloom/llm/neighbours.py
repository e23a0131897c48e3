"""Embedding near-duplicates: spherical k-means cells, blocked cosine products within them.

Equal vectors become one, with a count. Centroids are fitted on at most ``sample_rows``
vectors (a documented bound); every vector has a home cell, that of its nearest centroid,
and visits each further cell whose border with its own is at most half the angle of a link
away. No link is lost by that: the arc between two linked vectors crosses the border of
their cells, so one of them is within half its length of it. A vector is compared with all
vectors at home in the cells it visits. A pair that spans two cells is found by whichever
visits the other's home, and counts for both, once.

Neighbouring cells form a region. A vector goes once to each region it visits, with the cells
it visits there, not once to each cell. Regions are cut in blocks, so a task compares a block
of visitors with a block of residents, cell by cell and strip by strip, and returns counts and
spanning links, never pairs. A block grows with the table up to ``BLOCK_BYTES``: copies of a
vector are as many as there are blocks, twice at most, and a task's memory has a bound.

Defined results: null or empty vectors, zero vectors and vectors that hold null or
non-finite components link with nothing; vectors of another length than the most common
form a cell of their own per length; rows that share a vec_id are vectors of their own;
null vec_ids link with nothing and have a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.common import components, materialize

SAMPLE_ROWS = 20_000
MAX_CELLS = 1024
STRIP = 1024
# Cosines held at once.
PAIRS = 1 << 21
# Components of a block, as doubles.
BLOCK_BYTES = 32 << 20


def fit_cells(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit centroids by spherical k-means: assign by cosine, re-centre, normalise."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate(
            [np.argmax(part @ centres.T, axis=1) for part in np.array_split(sample, max(1, len(sample) // 2048))]
        )
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        held = norms > 1e-9
        centres[held] = sums[held] / norms[held, None]
    return centres


def _unit(vectors: pa.Array) -> np.ndarray:
    """Rows of unit length, in double precision; all rows have one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(vectors), -1)
    # Scaled first, so that very large or small components neither overflow nor vanish.
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    return rows


def _place(centres: np.ndarray, regions: np.ndarray, threshold: float):
    """(dims, home, region, visits, rep, copies, vector): ``visits`` are regions with the cells visited there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
        # The sine of half a link's angle, and a margin for rounding.
        reach = np.sqrt((1 - threshold) / 2) * apart + 1e-6
        for batch in batches:
            size = batch.column("dims").to_numpy()
            for dims in np.unique(size):
                rows = np.flatnonzero(size == dims)
                for low in range(0, len(rows), STRIP):
                    part = batch.take(pa.array(rows[low : low + STRIP]))
                    if dims == centres.shape[1]:
                        near = _unit(part.column("vector")) @ centres.T
                        home = near.argmax(axis=1)
                        goes = near.max(axis=1, keepdims=True) - near <= reach[home]
                    else:
                        home, goes = np.zeros(len(part), np.int64), np.ones((len(part), 1), bool)
                    row, cell = np.nonzero(goes)
                    # Cells are numbered by region, so those of one region follow each other.
                    first = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(regions[cell], prepend=-1))
                    cells = pa.ListArray.from_arrays(
                        np.append(first, len(cell)).astype(np.int32), pa.array(cell, pa.int32())
                    )
                    stays = pa.StructArray.from_arrays(
                        [pa.array(regions[cell[first]], pa.int32()), cells], ["region", "cells"]
                    )
                    begins = np.searchsorted(row[first], np.arange(len(part) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("dims"),
                            pa.array(home, pa.int32()),
                            pa.array(regions[home], pa.int32()),
                            pa.ListArray.from_arrays(begins, stays),
                            part.column("rep"),
                            part.column("copies"),
                            part.column("vector"),
                        ],
                        names=["dims", "home", "region", "visits", "rep", "copies", "vector"],
                    )

    return run


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values of a column of lists."""
    lists = column.combine_chunks()
    return pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy()


def _compare(cells: int, threshold: float):
    """Counts and spanning links of one block of visitors against one block of residents."""

    def run(group: pa.Table) -> pa.Table:
        resident = group.filter(pc.equal(group["side"], 0)).sort_by("home")
        visitor = group.filter(pc.equal(group["side"], 1))
        if not len(resident) or not len(visitor):
            return pa.table({c: pa.array([], pa.int64()) for c in ("node", "n", "label")})
        a, b = (_unit(side["vector"].combine_chunks()) for side in (visitor, resident))
        ids_a, ids_b = visitor["rep"].to_numpy(), resident["rep"].to_numpy()
        copies_a, copies_b = visitor["copies"].to_numpy(), resident["copies"].to_numpy()
        home_a, home_b = visitor["home"].to_numpy(), resident["home"].to_numpy()
        guest, visited = _lists(visitor["cells"])
        order = np.argsort(visited, kind="stable")
        guest, visited = guest[order], visited[order]
        host, seen = _lists(resident["cells"])
        n_a, n_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        label_a, label_b = ids_a.copy(), ids_b.copy()
        links = []
        for cell in np.unique(home_b):
            first, last = np.searchsorted(home_b, [cell, cell + 1])
            guests = guest[slice(*np.searchsorted(visited, [cell, cell + 1]))]
            # A resident that visits the other's home finds the pair there by itself.
            sees = np.zeros((last - first, cells), dtype=bool)
            mine = slice(*np.searchsorted(host, [first, last]))
            sees[host[mine] - first, seen[mine]] = True
            strip = max(1, PAIRS // (last - first))
            for low in range(0, len(guests), strip):
                some = guests[low : low + strip]
                row, col = np.nonzero(a[some] @ b[first:last].T >= threshold)
                row, col = some[row], first + col
                other = ids_a[row] != ids_b[col]
                row, col = row[other], col[other]
                if not len(row):
                    continue
                np.add.at(n_a, row, copies_b[col])
                alone = ~sees[col - first, home_a[row]]
                np.add.at(n_b, col[alone], copies_a[row[alone]])
                # Labels spread over the strip's links until they stand still.
                before = np.r_[label_a, label_b]
                while True:
                    least = np.minimum(label_a[row], label_b[col])
                    if (least == label_a[row]).all() and (least == label_b[col]).all():
                        break
                    np.minimum.at(label_a, row, least)
                    np.minimum.at(label_b, col, least)
                # A label that gives way is linked to the one that takes its place.
                moved = pd.DataFrame({"node": before, "n": 0, "label": np.r_[label_a, label_b]})
                links.append(moved[moved["node"] != moved["label"]].drop_duplicates())
        ids, n = np.r_[ids_a, ids_b], np.r_[n_a, n_b]
        counts = pd.DataFrame({"node": ids, "n": n, "label": ids})[n > 0]
        return pa.Table.from_pandas(pd.concat([counts, *links]), preserve_index=False)

    return run


def near_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    cell_rows: int = 256,
    max_cells: int = MAX_CELLS,
    sample_rows: int = SAMPLE_ROWS,
    block_rows: int = 4096,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each row of ``vectors``.

    A block holds an eighth of the vectors, but ``block_rows`` at least and ``BLOCK_BYTES`` at most.
    """
    raw = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    # Vectors given as floats travel as floats.
    given = vectors.select(vector).schema[0].dataType
    travels = given if given == T.ArrayType(T.FloatType()) else T.ArrayType(T.DoubleType())
    bad = F.exists(
        "vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    valid = (
        F.col("vector").isNotNull() & F.col("vec_id").isNotNull() & (F.size("vector") > 0)
        & ~F.coalesce(bad, F.lit(True)) & F.exists("vector", lambda x: x != 0)
    )
    rows = raw.withColumn("digest", F.when(valid, F.md5(F.array_join(F.col("vector").cast("array<string>"), ","))))
    rows = rows.withColumn("dims", F.size("vector"))
    named = rows.where("digest is not null")
    classes = materialize(
        named.groupBy("digest").agg(
            F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.first("dims").alias("dims"),
            F.first("vector").cast(travels).alias("vector"),
        )
        # Vectors that share a vec_id stay apart.
        .withColumn("rep", F.monotonically_increasing_id()),
        "classes",
    )
    by_length = classes.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    dims = by_length["dims"] if by_length else 1
    total = by_length["count"] if by_length else 0
    sample = (
        classes.where(F.col("dims") == dims)
        .orderBy(F.xxhash64(F.lit("sample"), "digest"), "digest")
        .limit(sample_rows)
        .select("vector")
        .toArrow()
    )
    cells = int(min(max_cells, max(1, total // cell_rows)))
    centres = fit_cells(_unit(sample.column(0).combine_chunks()), cells) if total else np.zeros((1, 1))
    share = max(block_rows, -(-total // 8))
    hubs = fit_cells(centres, max(1, min(cells, total // min(share, max(1, BLOCK_BYTES // (8 * dims))))))
    regions = (centres @ hubs.T).argmax(axis=1)
    order = np.argsort(regions, kind="stable")
    centres, regions = centres[order], regions[order]
    placed = materialize(
        classes.select("rep", "copies", "dims", "vector").mapInArrow(
            _place(centres, regions, threshold),
            "dims int, home int, region int, visits array<struct<region int, cells array<int>>>, "
            f"rep long, copies long, vector {classes.schema['vector'].dataType.simpleString()}",
        ),
        "placed",
    )
    every = ["dims", "region", "side", "home", "cells", "rep", "copies", "vector"]
    residents = placed.withColumn("side", F.lit(0)).withColumn("cells", F.flatten("visits.cells")).select(every)
    visitors = placed.drop("region").withColumn("side", F.lit(1)).select("*", F.inline("visits")).select(every)
    held = F.greatest(F.lit(1), F.least(F.lit(share), F.lit(BLOCK_BYTES) / (8 * F.col("dims"))))
    # At most max_cells regions, and one for each odd length.
    parts = (
        residents.unionAll(visitors).groupBy("dims", "region")
        .agg(F.count_if(F.col("side") == 0).alias("nr"), F.count_if(F.col("side") == 1).alias("nv"))
        .where("nr > 0")
        .select("dims", "region", *[
            F.greatest(F.lit(1), F.round(F.col(n) / held)).cast("int").alias(b) for n, b in (("nr", "br"), ("nv", "bv"))
        ])
    )

    def block(rows: DataFrame, own: str, others: str) -> DataFrame:
        cut = rows.join(F.broadcast(parts), ["dims", "region"])
        cut = cut.withColumn(own, F.pmod(F.xxhash64("rep"), F.col(f"b{own}")).cast("int"))
        cut = cut.withColumn(others, F.explode(F.sequence(F.lit(0), F.col(f"b{others}") - 1)))
        return cut.select(*every, "r", "v")

    compared = block(residents, "r", "v").unionAll(block(visitors, "v", "r")).groupBy("dims", "region", "r", "v")
    found = materialize(compared.applyInArrow(_compare(cells, threshold), "node long, n long, label long"), "found")
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("node").alias("src"), F.col("label").alias("dst")))
    per_class = (
        classes.select("digest", "rep", "copies", "least")
        .join(links, F.col("rep") == F.col("node"), "left")
        .drop("node")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select(
            "digest",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
            "least",
        )
    )
    names = per_class.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = per_class.join(names, "component").drop("component", "least")
    return rows.select("vec_id", "digest").join(per_class, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )

"""Vector code compression: integer product codes, nearest entries by Orchard's search.

Vectors become integers ``floor(scale * x)`` and are cut into equal parts; each part
position has a codebook, improved over a fixed number of rounds of assignment and
re-centring, all in whole numbers, so results do not depend on the order of addition.

The nearest entry of a part is found by Orchard's search. Every entry keeps a list of the
others by distance. From the best entry so far its list is walked outwards; an entry that
is nearer takes over and its own list is walked from the front; entries met before are
marked and not measured again; the walk ends at the first one more than twice as far from
the best entry as the part is, since none beyond can be nearer. Ties go to the lower index.
The parts of a batch walk side by side on arrays.

A round is one pass over the vectors. Tasks return a count and sums for each entry of each
codebook, which Spark adds up; the driver holds the codebooks only, ``entries`` vectors.

Defined results: rows whose vector is null or holds null or non-finite components are
dropped, as are vectors of another length than the most common one (the longest of equally
common ones) or of a length that does not divide into the parts; with fewer kept vectors than entries the
codebooks are shorter; rows that share a vec_id count one by one, the starting entries in
order of vec_id and then of components; a null vec_id comes last there; an empty table gives
an empty result. Components whose integers reach ``2**26`` are refused with an error, as
squared distances would leave 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 26
STRIP = 8192


class Codebook:
    """Entries of one part position, each with its list of the others by distance."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        # An entry heads its own list, equal entries by index.
        np.fill_diagonal(apart, -1)
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the entry nearest to each part."""
        n, size = len(parts), len(self.entries)
        best = np.zeros(n, dtype=np.int64)
        far = ((parts - self.entries[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, size), dtype=bool)
        seen[:, 0] = True
        place = np.ones(n, dtype=np.int64)
        walking = np.arange(n) if size > 1 else np.arange(0)
        while len(walking):
            b, p = best[walking], place[walking]
            # Squared distances: twice as far is four times as much.
            near = self.apart[b, p] <= 4 * far[walking]
            walking, b, p = walking[near], b[near], p[near]
            other = self.order[b, p]
            fresh = ~seen[walking, other]
            met, at = walking[fresh], other[fresh]
            seen[met, at] = True
            d = ((parts[met] - self.entries[at]) ** 2).sum(axis=1)
            better = (d < far[met]) | ((d == far[met]) & (at < best[met]))
            place[walking] = p + 1
            jump = met[better]
            best[jump], far[jump], place[jump] = at[better], d[better], 1
            walking = walking[place[walking] < size]
        return best, far


def _strips(batch: pa.RecordBatch, parts: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, a matrix for each part position) of runs of rows."""
    column = batch.column("whole")
    for low in range(0, len(column), STRIP):
        some = column.slice(low, STRIP)
        rows = some.flatten().to_numpy().reshape(len(some), -1)
        yield low, np.split(rows, parts, axis=1)


def _assigned_sums(books: list[Codebook]):
    """Count and sums of the parts assigned to each entry, one row for each in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b.entries), dtype=np.int64) for b in books]
        sums = [np.zeros_like(b.entries) for b in books]
        for batch in batches:
            for _, cut in _strips(batch, len(books)):
                for k, (book, parts) in enumerate(zip(books, cut)):
                    near, _ = book.nearest(parts)
                    counts[k] += np.bincount(near, minlength=len(counts[k]))
                    np.add.at(sums[k], near, parts)
        rows = [(k, e, int(c), s.tolist()) for k in range(len(books)) for e, (c, s) in enumerate(zip(counts[k], sums[k])) if c]
        part, entry, n, total = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(total, pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"],
        )

    return run


def _encoded(books: list[Codebook]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, len(books)), dtype=np.uint8)
            error = np.zeros(batch.num_rows, dtype=np.int64)
            for low, cut in _strips(batch, len(books)):
                for k, (book, parts) in enumerate(zip(books, cut)):
                    near, far = book.nearest(parts)
                    codes[low : low + len(near), k] = near
                    error[low : low + len(near)] += far
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in batch.schema.names if c != "whole"],
                    pa.array([row.tobytes() for row in codes], pa.binary()),
                    pa.array(error, pa.int64()),
                ],
                names=[*[c for c in batch.schema.names if c != "whole"], "code", "error"],
            )

    return run


def whole_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int, parts: int) -> DataFrame:
    """(vec_id, label, whole): the kept vectors in whole numbers, all of one length."""
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")
    )
    infinite = F.lit(float("inf"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    kept = rows.where(F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    by_length = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    whole = F.transform("v", lambda x: F.floor(x * scale))
    checked = F.when(
        F.exists("v", lambda x: F.abs(x) * scale >= LIMIT - 1), F.raise_error(F.lit("component too large for 64 bits"))
    ).otherwise(whole)
    return kept.where(F.size("v") == (by_length["n"] if by_length else 0)).select(
        "vec_id", "label", checked.cast("array<bigint>").alias("whole")
    )


def compress_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error) for each kept row, and the codebooks: part, entry, component.

    A code is a byte for each part, the index of its entry; ``decode_vectors`` turns it back.
    Without any kept row there are no codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    rows = materialize(whole_vectors(vectors, vec_id, vector, label, scale, parts), "whole-vectors")
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).select("whole").collect()
    if not start:
        empty = rows.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.limit(0), None
    first = np.array([r["whole"] for r in start], dtype=np.int64)
    books = np.stack(np.split(first, parts, axis=1))
    for _ in range(rounds):
        found = rows.select("whole").mapInArrow(
            _assigned_sums([Codebook(b) for b in books]), "part int, entry int, n long, total array<bigint>"
        )
        by_component = found.select("part", "entry", "n", F.posexplode("total").alias("at", "total"))
        # A row for each component of each entry, whatever the number of vectors.
        for r in by_component.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            books[r["part"], r["entry"], r["at"]] = r["total"] // r["n"]
    ids = [rows.schema["vec_id"].simpleString().split(":", 1)[1], rows.schema["label"].simpleString().split(":", 1)[1]]
    coded = rows.mapInArrow(
        _encoded([Codebook(b) for b in books]), f"vec_id {ids[0]}, label {ids[1]}, code binary, error long"
    )
    return coded, books


def decode_vectors(codes: DataFrame, books: np.ndarray, *, code: str = "code", scale: int = SCALE) -> DataFrame:
    """``codes`` with the vector its code stands for, as ``approximate``."""
    table = F.array(*[F.array(*[F.lit(e.tolist()) for e in part]) for part in books])
    index = F.sequence(F.lit(0), F.lit(len(books) - 1))
    part = F.transform(
        index, lambda k: table[k][F.conv(F.hex(F.substring(F.col(code), k + 1, F.lit(1))), 16, 10).cast("int")]
    )
    return codes.withColumn("approximate", F.transform(F.flatten(part), lambda x: (x + F.lit(0.5)) / scale))


def code_report(vectors: DataFrame, **options) -> DataFrame:
    """Per kept row: vec_id, code in hex, error, the error of all rows of its label, digest of the codebooks."""
    coded, books = compress_vectors(vectors, **options)
    coded = materialize(coded, "codes")
    of_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    of_label = of_label.withColumnRenamed("label", "of")
    numbers = "" if books is None else ",".join(map(str, books.ravel().tolist()))
    return (
        coded.join(of_label, F.col("label").eqNullSafe(F.col("of")))
        .select(
            "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
            F.sha2(F.lit(numbers), 256).alias("codebooks_sha256"),
        )
    )

"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Features are word 1- and 2-grams, and 1- to 3-grams of word shapes (kinds of characters,
first and last character, length class, equality with the word before), hashed to
2**HASH_BITS weights. A document's value for a feature is its share of the document's
n-grams of that kind, so a score is a sparse dot product: a mean of weights, summed over
the kinds, plus the bias.

Training reads a sample of at most ``sample_rows`` labelled documents (a documented bound),
drawn by hash, dealt over a fixed number of learners whose weights are averaged. A learner
sees its documents in order of a hash, in small batches, with one adaptive rate and one L1
threshold for each weight. The model has a fixed size and goes to the tasks as a constant.

Defined results: null and empty texts have no features and get the score of the bias;
without labelled documents every score is 0.5; repeated labels of a document are averaged;
null labels are left out; a null doc_id has no label and counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanloom.llm.tokens import FOLDED_VALUE, NOT_BLANK, Words, chunks, mixed

HASH_BITS = 18
SAMPLE_ROWS = 20_000
LEARNERS = 4
SCALE = 12.0
THRESHOLD = 0.3

_KIND = np.full(256, 32, dtype=np.uint8)
_KIND[0:128] = 16
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 2, 4
_KIND[[44, 46]] = 8


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


def held_out(doc_id: Column) -> Column:
    """One document in five, by checksum of its id; never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")), F.lit(0)) % 5 == 0


def _shapes(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """A word's shape depends on its own document only, whatever stands beside that in the chunk."""
    start, end = words.start, words.end
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    kinds = _KIND[data]
    opening = words.offsets[:-1]
    # The blanks after a word count with it, those a document begins with do not.
    low, high = offsets[:-1], np.minimum(np.append(start, len(data))[opening], offsets[1:])
    for i in np.flatnonzero(high > low):
        kinds[low[i] : high[i]] = 0
    mask = np.bitwise_or.reduceat(kinds, start)
    length = end - start
    first, last = kinds[start], kinds[end - 1]
    twice = (data[np.maximum(end - 2, start)] == data[end - 1]) & (length > 1)
    same = np.zeros(len(start), dtype=bool)
    same[1:] = words.hash[1:] == words.hash[:-1]
    same[opening[opening < len(same)]] = False
    size = np.minimum(length, 20) // 3
    shape = mask.astype(np.uint64)
    for part, width in ((first, 64), (last, 64), (twice, 2), (same, 2), (size, 8)):
        shape = shape * np.uint64(width) + part.astype(np.uint64)
    return mixed(shape + np.uint64(1 << 40))


def _grams(values: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Weight index of every ``size`` consecutive values; grams may span a document's end."""
    out = values.copy()
    for k in range(1, size):
        out[: len(out) - k] = out[: len(out) - k] * np.uint64(0x9E3779B97F4A7C15) + values[k:]
    return (mixed(out + np.uint64(salt)) >> np.uint64(64 - HASH_BITS)).astype(np.int32)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram of a chunk: weight indexes and the rows' bounds in them."""
    words = Words(data, offsets, NOT_BLANK, FOLDED_VALUE)
    shapes = _shapes(data, offsets, words)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(words.offsets))
    for values, size, salt in (
        (words.hash, 1, 11), (words.hash, 2, 12), (shapes, 1, 21), (shapes, 2, 22), (shapes, 3, 23),
    ):
        index = _grams(values, size, salt)
        if size > 1 and len(rows):
            inside = np.zeros(len(rows), dtype=bool)
            inside[: len(rows) - size + 1] = rows[size - 1 :] == rows[: len(rows) - size + 1]
            yield index[inside], np.searchsorted(rows[inside], np.arange(len(offsets)))
        else:
            yield index, words.offsets


def _score(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.full(len(offsets) - 1, model.bias)
    for index, bounds in features(data, offsets):
        n = np.diff(bounds)
        rows = np.repeat(np.arange(len(n)), n)
        sums = np.bincount(rows, weights=model.weights[index], minlength=len(n))
        total += SCALE * sums / np.maximum(n, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def _vectors(text: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse vectors (indexes, values) of the rows of a column."""
    out: list[list[np.ndarray]] = [[] for _ in range(len(text))]
    values: list[list[np.ndarray]] = [[] for _ in range(len(text))]
    for first, data, offsets in chunks(text):
        for index, bounds in features(data, offsets):
            for i in range(len(offsets) - 1):
                part = index[bounds[i] : bounds[i + 1]]
                if len(part):
                    ids, n = np.unique(part, return_counts=True)
                    out[first + i].append(ids)
                    values[first + i].append(SCALE * n / len(part))
    empty = (np.zeros(0, np.int32), np.zeros(0))
    return [
        (np.concatenate(a), np.concatenate(b)) if a else empty for a, b in zip(out, values)
    ]


def _learn(
    vectors: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    *,
    passes: int,
    batch: int,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
) -> np.ndarray:
    """FTRL-proximal: weights from accumulated gradients z and squares n; the last is the bias."""
    size = (1 << HASH_BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weight(index: np.ndarray) -> np.ndarray:
        big = np.maximum(np.abs(z[index]) - l1, 0.0) * -np.sign(z[index])
        return big / ((beta + np.sqrt(n[index])) / alpha + l2)

    for _ in range(passes):
        for at in range(0, len(vectors), batch):
            rows = vectors[at : at + batch]
            lengths = [len(ids) + 1 for ids, _ in rows]
            index = np.concatenate([np.r_[ids, size - 1] for ids, _ in rows])
            value = np.concatenate([np.r_[v, 1.0] for _, v in rows])
            owner = np.repeat(np.arange(len(rows)), lengths)
            used, place = np.unique(index, return_inverse=True)
            held = weight(used)
            margin = np.bincount(owner, weights=held[place] * value, minlength=len(rows))
            error = 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35))) - labels[at : at + batch]
            gradient = np.bincount(place, weights=error[owner] * value, minlength=len(used))
            after = n[used] + gradient**2
            z[used] += gradient - (np.sqrt(after) - np.sqrt(n[used])) / alpha * held
            n[used] = after
    return weight(np.arange(size))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    learners: int = LEARNERS,
    passes: int = 4,
    batch: int = 16,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> Model:
    """Weights from labelled documents that are not held out."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("__id"))
        .agg(F.avg(label).alias("__y"))
    )
    total = known.count()
    # The sample is drawn by hash, so it is the same whatever the partitions.
    if total > sample_rows:
        share = int(2**31 * 0.9 * sample_rows / total)
        known = known.where(F.pmod(F.xxhash64(F.lit("sample"), "__id"), F.lit(2**31)) < share)
    chosen = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(
        F.broadcast(known.limit(sample_rows)), "__id"
    )
    chosen = chosen.withColumn("learner", F.pmod(F.xxhash64(F.lit("learner"), "__id"), F.lit(learners)))

    def learn(rows: pa.Table) -> pa.Table:
        frame = rows.select(["__id", "__y"]).to_pandas()
        mix = mixed(frame["__id"].to_numpy().astype(np.int64).view(np.uint64) + np.uint64(77))
        order = np.lexsort((frame["__y"].to_numpy(), mix))
        column = rows.column("__text").combine_chunks()
        vectors = _vectors(column.take(pa.array(order)) if len(column) else column)
        weights = _learn(
            vectors, frame["__y"].to_numpy()[order],
            passes=passes, batch=batch, alpha=alpha, beta=beta, l1=l1, l2=l2,
        )
        return pa.table({"w": pa.array([weights.astype(np.float32).tobytes()], pa.binary())})

    models = chosen.groupBy("learner").applyInArrow(learn, "w binary").collect()  # a fixed few
    if not models:
        return Model(np.zeros(1 << HASH_BITS), 0.0)
    mean = np.mean([np.frombuffer(m["w"], dtype=np.float32).astype(float) for m in sorted(models)], axis=0)
    return Model(mean[:-1], float(mean[-1]))


def score_documents(docs: DataFrame, model: Model, *, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score of each row, between 0 and 1. A column of that name is replaced."""
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    constant = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = constant.value
        for batch in batches:
            scores = np.full(batch.num_rows, np.nan)
            for first, data, offsets in chunks(batch.column(text)):
                scores[first : first + len(offsets) - 1] = _score(held, data, offsets)
            arrays = [*batch.columns, pa.array(scores)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    name = "__score"
    scored = score_documents(docs, train(docs, labels, text=text, **options), text=text, column=name)
    return scored.where(F.col(name) >= THRESHOLD).drop(name)



"""Which hashed features of a document occur elsewhere, found without moving the texts.

Every task packs the features of a block of documents as sorted integers, split by leading
bits into buckets. Buckets meet their blocks' packages in one shuffle of about six bytes a
feature; features found twice go back to their block in a second, smaller one. A feature
that a block has twice is known to be shared there: one entry of it leaves the block, so a
feature of a third of all documents costs its bucket one entry a block.

A feature is ``HASH_BITS`` wide, enough for the comparison of two documents; a chance match
with some third document only adds a feature to look at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HASH_BITS = 48
BLOCK_DOCS = 1 << 14
BLOCK_FEATURES = 2_000_000
BUCKET_BYTES = 4 << 20
ID_BITS = 16
MANY = (1 << ID_BITS) - 1  # in place of a document: several of the block

# (first row of the chunk, bytes, offsets) -> feature hashes, their rows, size of each row
Extract = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def packed(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, plane by plane: sorted values then compress well."""
    raw = values.astype(np.uint64).view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(raw[:, :width].T[::-1]).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(width, -1)
    raw = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    raw[:, :width] = planes[::-1].T
    return raw.view(np.uint64).ravel()


def stored_bytes(bits: int) -> int:
    """Bytes of a feature and its document without the bucket's bits."""
    return -(-(64 - bits) // 8)


def bucket_bits_for(text_bytes: int) -> int:
    """So many buckets that each has the features of about ``BUCKET_BYTES`` of text."""
    return min(20, max(6, (text_bytes // BUCKET_BYTES).bit_length()))


def _distinct(values: np.ndarray, times: int) -> np.ndarray:
    """Sorted, each value at most ``times`` (1 or 2) times."""
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    keep[times:] = values[times:] != values[:-times]
    return values[keep]


def _blocks(extract: Extract, bits: int, times: int, counted: bool) -> Callable:
    """Rows (bucket, block, data) of a partition; bucket 2**bits + block tells its documents."""
    from spanloom.llm.tokens import CACHED_BYTES, chunks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        found: list[np.ndarray] = []
        docs = features = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, sizes, found, docs, features, count
            block = (part << 24) | count
            count += 1
            keys = _distinct(np.concatenate(found), times) if found else np.zeros(0, np.uint64)
            # A feature that the block has twice goes out once; its places stay with the block.
            local = keys >> np.uint64(ID_BITS)
            same = local[1:] == local[:-1]
            first, again = np.r_[True, ~same], np.r_[same, False] | np.r_[False, same]
            if not len(keys):
                first = again = np.zeros(0, dtype=bool)
            places = _distinct(keys[again], 1)
            runs = np.diff(np.r_[np.flatnonzero(first), len(keys)])
            keys = np.where(again, keys | np.uint64(MANY), keys)[first]
            edges = np.searchsorted(
                keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
            )
            parts = np.split(keys, edges)
            rows = [(b, packed(p, stored_bytes(bits))) for b, p in enumerate(parts) if len(p)]
            if counted:
                # Behind the features, how often the block has those that it has twice.
                runs = [r[(p & np.uint64(MANY)) == MANY] for r, p in zip(np.split(runs, edges), parts) if len(p)]
                rows = [(b, r.astype(np.uint16).tobytes() + d + len(r).to_bytes(4, "little")) for (b, d), r in zip(rows, runs)]
            about = np.concatenate([np.concatenate(ids), np.concatenate(sizes)]).astype(np.int64)
            whole = np.int64(docs).tobytes() + about.tobytes() + packed(places, 8)
            rows.append(((1 << bits) + block % (1 << bits), whole))
            ids, sizes, found, docs, features = [], [], [], 0, 0
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([block] * len(rows), pa.int64()),
                    pa.array([r[1] for r in rows], pa.binary()),
                ],
                names=["bucket", "block", "data"],
            )

        for batch in batches:
            known = batch.column(0)
            for first, data, offsets in chunks(batch.column(1), CACHED_BYTES):
                rows = len(offsets) - 1
                if docs and (docs + rows > BLOCK_DOCS or features > BLOCK_FEATURES):
                    yield flush()
                hashes, rows_of, size = extract(data, offsets)
                for low in range(0, rows, BLOCK_DOCS):
                    high = min(rows, low + BLOCK_DOCS)
                    if docs and docs + high - low > BLOCK_DOCS:
                        yield flush()
                    mine = slice(*np.searchsorted(rows_of, [low, high]))
                    key = (hashes[mine] >> np.uint64(ID_BITS)) << np.uint64(ID_BITS)
                    found.append(key | (rows_of[mine] - low + docs).astype(np.uint64))
                    # Ids as whole numbers; a null has the least one.
                    ids.append(known.slice(first + low, high - low).fill_null(-(2**63)).to_numpy(zero_copy_only=False))
                    sizes.append(size[low:high])
                    docs += high - low
                    features += len(key)
        if docs:
            yield flush()

    return run


def _shared(bits: int, counted: bool) -> Callable:
    """Of one bucket: the features that occur at least twice, sent back to their blocks."""
    width = stored_bytes(bits)
    feature = np.uint64((1 << (HASH_BITS - bits)) - 1)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        if bucket >= 1 << bits:
            return table.set_column(0, "bucket", pa.array([-1] * len(table), pa.int32()))
        blocks = table.column("block").to_numpy()
        data, counts = [x.as_py() for x in table.column("data")], []
        if counted:
            many = [2 * int.from_bytes(x[-4:], "little") for x in data]
            counts = [np.frombuffer(x[:n], np.uint16) for x, n in zip(data, many)]
            data = [x[n:-4] for x, n in zip(data, many)]
        parts = [unpacked(x, width) for x in data]
        # Sorted by feature, then by the order in which they came.
        keys = np.concatenate(parts)
        hashes = (keys >> np.uint64(ID_BITS)) & feature
        index_bits = np.uint64(max(1, int(len(keys)).bit_length()))
        if HASH_BITS - bits + int(index_bits) <= 64:
            order = np.sort((hashes << index_bits) | np.arange(len(keys), dtype=np.uint64))
            at = (order & ((np.uint64(1) << index_bits) - np.uint64(1))).astype(np.int64)
        else:
            at = np.argsort(hashes, kind="stable")
        ordered = hashes[at]
        begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        runs = np.diff(np.r_[begins, len(ordered)])
        many = (keys & np.uint64(MANY)) == MANY
        weight = 1 + many.astype(np.int64)
        if counted:
            weight[many] = np.concatenate(counts)
        times = np.zeros(len(keys), dtype=np.int64)
        times[at] = np.repeat(np.add.reduceat(weight[at], begins), runs)
        out_block, out = [], []
        first = 0
        for block, part in zip(blocks, parts):
            n = times[first : first + len(part)]
            first += len(part)
            keep = n >= 2
            if keep.any():
                # id, frequency class, feature: sorts by document, rare features first.
                rank = np.minimum(np.log2(n[keep].astype(float)) * 8, 255).astype(np.uint64)
                ids = part[keep] & np.uint64((1 << ID_BITS) - 1)
                full = (np.uint64(bucket) << np.uint64(HASH_BITS - bits)) | (
                    (part[keep] >> np.uint64(ID_BITS)) & feature
                )
                out_block.append(block)
                out.append(ids.astype(np.uint16).tobytes() + rank.astype(np.uint8).tobytes() + packed(full, 6))
        return pa.table(
            {
                "bucket": pa.array([bucket] * len(out), pa.int32()),
                "block": pa.array(out_block, pa.int64()),
                "data": pa.array(out, pa.binary()),
            }
        )

    return run


def _per_document(block_rows: pa.Table, low_bits_only: bool, hot: int | None) -> pa.Table:
    """Of one block: a row for each document with its shared features, rare ones first."""
    ids, ranks, features = [np.zeros(0, np.uint16)], [np.zeros(0, np.uint8)], [np.zeros(0, np.uint64)]
    for bucket, data in zip(block_rows.column("bucket").to_pylist(), block_rows.column("data")):
        data = data.as_py()
        if bucket < 0:
            docs = int(np.frombuffer(data, np.int64, 1)[0])
            about = np.frombuffer(data, np.int64, 2 * docs, 8)
            places = unpacked(data[8 + 16 * docs :], 8)
            continue
        n = len(data) // 9
        ids.append(np.frombuffer(data, np.uint16, n))
        ranks.append(np.frombuffer(data, np.uint8, n, 2 * n))
        features.append(unpacked(data[3 * n :], 6))
    ids, ranks, features = map(np.concatenate, (ids, ranks, features))
    value = (ranks.astype(np.uint64) << np.uint64(HASH_BITS)) | features
    # The block's own repeats take the frequency class that came back for them.
    many = ids == MANY
    own = features[many]
    order = np.argsort(own)
    held = places >> np.uint64(ID_BITS)
    repeated = value[many][order][np.searchsorted(own[order], held)] if len(held) else held
    ids = np.concatenate([ids[~many], (places & np.uint64(MANY)).astype(np.uint16)])
    value = np.concatenate([value[~many], repeated])
    order = np.argsort(ids, kind="stable")
    value, cuts = value[order], np.searchsorted(ids[order], np.arange(docs + 1))
    lists = [np.sort(value[cuts[i] : cuts[i + 1]]) for i in range(docs)]
    more = {}
    if hot is not None:
        least = np.uint64(int(np.log2(hot) * 8) << HASH_BITS)
        low = np.uint64((1 << HASH_BITS) - 1)
        more["hot"] = pa.array([(x[np.searchsorted(x, least) :] & low).tobytes() for x in lists], pa.binary())
    return pa.table(
        {
            "doc_id": pa.array(about[:docs], pa.int64(), mask=about[:docs] == -(2**63)),
            "size": pa.array(about[docs:], pa.int64()),
            "n_shared": pa.array([len(x) for x in lists], pa.int64()),
            "shared": pa.array(
                [(x.astype(np.uint32) if low_bits_only else x).tobytes() for x in lists], pa.binary()
            ),
            **more,
        }
    )


def shared_features(
    docs: DataFrame,
    extract: Extract,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bits: int | None = None,
    repeats_count: bool = False,
    low_bits_only: bool = False,
    hot: int | None = None,
) -> DataFrame:
    """(doc_id, size, n_shared, shared): a row for each document.

    ``shared`` packs the features that occur in another document too (or twice in one, if
    ``repeats_count``) as 8-byte integers, frequency class above the hash, sorted: rare
    features first; with ``low_bits_only`` it has the hashes' low 32 bits alone. ``size`` is
    what ``extract`` says of the document. With ``hot``, features are counted in full, and a
    column of that name has the hashes of those found about ``hot`` times or more.

    A task holds one bucket, a 2**bucket_bits-th of all features; by default their number
    follows the bytes of text. Partitions must give their rows in the same order when they
    are computed again, as tables do.
    """
    if bucket_bits is None:
        bucket_bits = bucket_bits_for(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0)
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = source.mapInArrow(
        _blocks(extract, bucket_bits, 2 if repeats_count else 1, hot is not None), "bucket int, block long, data binary"
    )
    found = blocks.groupBy("bucket").applyInArrow(_shared(bucket_bits, hot is not None), "bucket int, block long, data binary")
    return found.groupBy("block").applyInArrow(
        lambda rows: _per_document(rows, low_bits_only, hot),
        "doc_id long, size long, n_shared long, shared binary" + ("" if hot is None else ", hot binary"),
    )

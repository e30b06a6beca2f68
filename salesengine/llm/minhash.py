"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles yields two signature values, its minimum and its maximum,
so 64 hash evaluations a shingle give 128 values. Bands of them are bucket keys. Documents
that share a bucket are compared on their whole shingle sets, in blocks of bounded size.

Texts that are null, empty or without a word have an empty set and link with nothing. Texts
with equal sets are one class, whose members are linked by definition. Rows that share a
doc_id are one vertex. Rows without a doc_id keep a null component and are not kept. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesengine.llm.common import (
    connected_components,
    crossing_buckets,
    dealt_in_blocks,
    local_roots,
    runs,
)
from salesengine.session import materialize

PERMUTATIONS = 64
BAND_ROWS = 5  # 25 bands of 128 values: a pair at 0.85 is missed with 4e-7, at 0.8 with 5e-5
#: Ids of compared documents that may be broadcast, 16 MB.
BROADCAST_IDS = 1 << 21
_CHUNK = 1 << 14
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_STEP = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX1
    x = (x ^ (x >> np.uint64(29))) * _MIX2
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than ``size`` are one shingle.

    Words are runs of other characters than space and \\t..\\r, which are what bytes.split()
    cuts at; bytes.lower() changes A-Z alone.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(_STEP) + hashes[k : len(words) - width + 1 + k]
    return np.unique(_mixed(out))


class Signer:
    """Band keys of a shingle set."""

    def __init__(self, permutations: int = PERMUTATIONS, rows: int = BAND_ROWS):
        dice = np.random.default_rng(20)
        self.a = (dice.integers(0, 1 << 31, permutations, dtype=np.uint32) * np.uint32(2)) | np.uint32(1)
        self.b = dice.integers(0, 1 << 32, permutations, dtype=np.uint64).astype(np.uint32)
        self.rows, self.bands = rows, 2 * permutations // rows
        self.weights = dice.integers(0, 1 << 62, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.numbers = _mixed(np.arange(1, self.bands + 1, dtype=np.uint64))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The minimum and the maximum under each permutation, side by side."""
        low = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        high = np.zeros(len(self.a), np.uint32)
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        for start in range(0, len(short), _CHUNK):
            x = short[None, start : start + _CHUNK] * self.a[:, None]
            x += self.b[:, None]
            np.minimum(low, x.min(axis=1), out=low)
            np.maximum(high, x.max(axis=1), out=high)
        return np.stack([low, high], axis=1).ravel()

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        values = self.signature(shingles)[: self.bands * self.rows].astype(np.uint64)
        banded = (values.reshape(self.bands, self.rows) + np.uint64(1)) * self.weights
        return _mixed(banded.sum(axis=1, dtype=np.uint64) ^ self.numbers).view(np.int64)


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer()
        for batch in batches:
            counts, digests, keys = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), size)
                counts.append(len(shingles))
                digests.append(hashlib.md5(shingles.tobytes()).digest())
                keys.append(signer.keys(shingles) if len(shingles) else np.empty(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            values = np.concatenate([*keys, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    return run


def _whole_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py(), size).tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.binary())],
                names=["id", "shingles"],
            )

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each two sets, by products of 0/1 matrices in chunks."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], float)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    rows, column = rows[shared], column[shared]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    fresh = np.concatenate([[True], column[1:] != column[:-1]]) if len(column) else np.empty(0, bool)
    column = np.cumsum(fresh) - 1
    out = np.zeros((len(sets), len(sets)))
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [start, start + width])
        x = np.zeros((len(sets), width), np.float32)
        x[rows[lo:hi], column[lo:hi] - start] = 1
        out += x @ x.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _links(numerator: int, denominator: int):
    """Of the rows of a pair of blocks: each id with the first id it is connected with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, ["key", "lo_block", "hi_block"]):
            if rows.num_rows < 2:
                continue
            ids = rows.column("id").to_numpy()
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in rows.column("shingles").combine_chunks()]
            sizes = np.array([len(s) for s in sets], float)
            both = common_counts(sets)
            union = sizes[:, None] + sizes[None, :] - both
            root = local_roots(denominator * both >= numerator * union)
            moved = root != np.arange(len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["a", "b"]
            )

    return run


def near_duplicates(
    documents: DataFrame, shingle: int = 5, numerator: int = 80, denominator: int = 100
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``documents``.

    Two documents are linked if intersection * denominator >= union * numerator, for the sets
    of their distinct shingles of ``shingle`` words. component_id is the smallest doc_id that
    can be reached over links; kept marks the rows whose doc_id it is.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = materialize(
        source.mapInArrow(
            _sign(shingle), "doc_id long, n_shingles long, digest binary, bands array<long>"
        )
    )
    sized = signed.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(
        sized.groupBy("digest").agg(
            F.min("doc_id").alias("id"),
            F.min("n_shingles").alias("weight"),
            F.any_value("bands").alias("bands"),
            F.count("*").alias("rows"),
        )
    )
    repeated = classes.where("rows > 1").select("digest", "id")
    copies = sized.select("doc_id", "digest").join(repeated, "digest")
    members = classes.select("id", "weight", F.explode("bands").alias("key"))
    buckets = crossing_buckets(members)
    crossing = materialize(members.join(buckets, "key").select("key", "blocks", "id"))
    wanted = materialize(crossing.select(F.col("id").alias("doc_id")).distinct())
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)  # else both sides are shuffled
    sets = source.join(wanted, "doc_id", "left_semi").mapInArrow(
        _whole_sets(shingle), "id long, shingles binary"
    )
    near = dealt_in_blocks(crossing.join(materialize(sets), "id")).mapInArrow(
        _links(numerator, denominator), "a long, b long"
    )
    edges = near.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    component = connected_components(edges)
    joined = signed.select("doc_id", "n_shingles").join(
        component, F.col("doc_id") == F.col("id"), "left"
    )
    found = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        found.alias("component_id"),
        F.coalesce(found == F.col("doc_id"), F.lit(False)).alias("kept"),
    )


def op1_minhash_dedup(spark, folder: str) -> DataFrame:
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return near_duplicates(documents, shingle=3, numerator=85, denominator=100)

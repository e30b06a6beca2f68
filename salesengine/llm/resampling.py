"""Importance resampling towards a target, with weights from bit-sliced counts.

A feature is a run of one to three words; its bucket is a checksum. The buckets are counted
over all documents and over the whole target, and a bucket's gain is the floored logarithm of
how much more frequent it is in the target. The gains are cut once into bit planes: plane k
holds, for every bucket, bit k of the gain in two's complement, so the top plane counts
negatively. A document's bucket counts are cut into planes the same way. The weight, the sum
of count times gain, is then the sum over all pairs of planes of a power of two times the
number of common bits: AND and popcount over whole machine words, exact in integers.

A seeded score draws the documents: weight plus Gumbel noise from a hash of the id. The best
are ranked by a range sort of the narrow scores, so no rank needs one task.

Null and empty texts have no words, no features and weight 0. A null id hashes as the empty
text. Repeated rows stay one by one; rows that agree in id and score are ranked among
themselves in any order. An empty target gives every bucket a gain from T = 0. Documents
under ``least_words`` words are scored and never drawn. Other columns are not read. A text is
taken in blocks, so a very long one costs its own size and no more.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from salesengine.llm.common import table
from salesengine.llm.decontaminate import words_of
from salesengine.operators.ranking import global_rank
from salesengine.session import materialize

BUCKETS, LONGEST_RUN = 10_000, 3
SEED, PERCENT, LEAST_WORDS = 42, 5, 20
#: Characters of a text that become words at a time, and documents that are counted at a time.
BLOCK, TOGETHER = 1 << 20, 128
_LANES = -(-BUCKETS // 64)  # 64-bit words of a plane


def _blocks(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in pieces that end between words."""
    text, start = text or "", 0
    while start < len(text):
        end = start + BLOCK
        while end < len(text) and text[end] not in " \t\r\n":  # a longer run is one piece
            end += 1
        yield words_of(text[start:end])
        start = end


def buckets_of(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """(words, buckets of the runs that end in them), piece by piece."""
    carried: list[bytes] = []
    for block in _blocks(text):
        words, old = carried + block, len(carried)
        spaced = [b" " + w for w in words]
        sums = list(map(crc32, words))
        found = [sums[old:]]
        for more in range(1, LONGEST_RUN):
            sums = list(map(crc32, spaced[more:], sums))  # a checksum goes on where it ended
            found.append(sums[max(0, old - more) :])
        carried = words[1 - LONGEST_RUN :]
        yield len(block), np.concatenate([np.array(f, np.int64) for f in found]) % BUCKETS


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            for _, buckets in buckets_of(text.as_py()):
                total += np.bincount(buckets, minlength=BUCKETS)
    filled = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(filled, pa.int64()), pa.array(total[filled], pa.int64())], names=["bucket", "n"]
    )


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts; a task sends one row per bucket."""
    text = texts.select(F.col("text").cast("string").alias("text"))
    counted = text.mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS, np.int64)
    for r in counted.collect():  # at most BUCKETS rows
        total[r.bucket] = r.n
    return total


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floored gain of every bucket, in thousandths."""
    all_s, all_t = float(documents.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    ratios = ((target + 1.0) * all_s) / ((documents + 1.0) * all_t)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], np.int64)


def planes(values: np.ndarray, bits: range) -> np.ndarray:
    """(bits, rows, lanes): the plane of bit k of every bucket's value, in two's complement."""
    out = np.zeros((len(bits), len(values), _LANES * 8), np.uint8)
    for at, k in enumerate(bits):
        out[at, :, : -(-BUCKETS // 8)] = np.packbits((values & 1 << k) != 0, axis=1)
    return out.view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The planes of the gains and what a bit in each of them is worth."""
    bits = int(np.abs(gain).max()).bit_length() + 1
    return planes(gain[None, :], range(bits))[:, 0], [1 << k for k in range(bits - 1)] + [-(1 << bits - 1)]


def weights(counts: np.ndarray, gain: tuple[np.ndarray, list[int]]) -> list[int]:
    """Sum of count times gain for each row of counts, from common bits alone."""
    total = [0] * len(counts)
    most = counts.max(axis=1, initial=0)
    for j in range(int(most.max(initial=0)).bit_length()):
        rows = np.flatnonzero(most >> j)
        held = planes(counts if len(rows) == len(counts) else counts[rows], range(j, j + 1))[0]
        sums = np.zeros(len(rows), object)  # whole numbers of any size
        for plane, worth in zip(*gain, strict=True):
            common = np.bitwise_count(held & plane).sum(axis=1, dtype=np.int64)
            sums += common.astype(object) * (worth << j)
        for row, value in zip(rows.tolist(), sums.tolist(), strict=True):
            total[row] += value
    return total


def _weigh(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                counts, words = np.zeros((part.num_rows, BUCKETS), np.int32), []
                for i, text in enumerate(part.column("text")):
                    words.append(0)
                    for n, buckets in buckets_of(text.as_py()):
                        words[-1] += n
                        counts[i] += np.bincount(buckets, minlength=BUCKETS).astype(np.int32)
                columns = {
                    "doc_id": part.column("doc_id"),
                    "n_words": pa.array(words, pa.int64()),
                    "n_features": pa.array(counts.sum(axis=1, dtype=np.int64)),
                    "weight": pa.array(weights(counts, gain), pa.int64()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return run


def importance(documents: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score), a row per document.

    Two passes over the texts: one for the counts, one for the weights. Only the table of
    gains, whose size is fixed, is broadcast.
    """
    gain = gain_planes(gains(bucket_counts(documents), bucket_counts(target)))
    shared = documents.sparkSession.sparkContext.broadcast(gain)
    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    weighed = source.mapInArrow(
        _weigh(shared), "doc_id long, n_words long, n_features long, weight long"
    )
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", (F.col("weight") + noise).cast("long"))


def resample(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """The importance of every document, and ``rank``: 1, 2, 3 … for the drawn, null for others.

    Of the documents with ``least_words`` words the best ``percent`` of a hundred are drawn,
    rounded down; the smaller id wins among equal scores, and no id comes last.
    """
    seen = Observation()
    eligible = F.col("n_words") >= least_words
    scored = importance(documents, target, seed)
    scored = materialize(scored.observe(seen, F.count_if(eligible).alias("n")))
    drawn = percent * seen.get["n"] // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("n_words")]
    ranked = global_rank(scored.where(eligible), order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return ranked.unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows with all their columns; rows that share a drawn id all come."""
    ids = resample(documents, target, **options).where("rank is not null").select("doc_id")
    ids = ids.distinct().withColumnRenamed("doc_id", "_drawn")
    return documents.join(ids, F.col("doc_id").eqNullSafe(F.col("_drawn")), "left_semi")


def op11_resampling(spark, folder: str) -> DataFrame:
    found = resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")

"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every word is hashed to one of a fixed number of rows. A row's vector is the sum of the sparse
random index vectors of the words beside it, over all documents, so its size is fixed while
what it gathers grows with the corpus. A document is the mean of the vectors of its words and
a few shares (repeated words and lines, symbols, capitals, length). A network with one hidden
layer is trained in numpy on a bounded sample of labelled documents, and its temperature is
set on a part of that sample. Labels, language, source and ids are never inputs.

Null and empty texts have no words and get a score like all others. Without labels of both
kinds the score is the smoothed share of good labels. Rows stay one by one, with all their
columns inside ``row``; ids that are null are scored and never trained on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from salesengine.llm.common import table

ROWS, WIDTH, NONZERO = 1 << 14, 32, 2
CHUNKS = 64  # pieces in which the table of word vectors is summed
#: The most labelled documents that are trained on, those with the least hash of their id.
TRAINED = 20_000
GATHERED = 1 << 20  # words that are added up at a time
HIDDEN, EPOCHS, BATCH = 32, 40, 256
FOLDS = 5
ACCEPTED = 0.3

_TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\s]+")


def tokens_of(text: str | None) -> list[bytes]:
    """Runs of letters, of digits and of symbols."""
    return _TOKEN.findall((text or "").encode())


def rows_of(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens)) & (ROWS - 1)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few nonzero entries of each row's index vector."""
    dice = np.random.default_rng(10)
    return dice.integers(0, WIDTH, (ROWS, NONZERO)), dice.choice([-1.0, 1.0], (ROWS, NONZERO))


def add_contexts(total: np.ndarray, rows: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> None:
    """Add to each row the index vectors of the words before and after it."""
    places, signs = index
    for word, other in ((rows[:-1], rows[1:]), (rows[1:], rows[:-1])):
        for k in range(NONZERO):
            total += np.bincount(word * WIDTH + places[other, k], signs[other, k], len(total))


def _chunked(total: np.ndarray) -> pa.RecordBatch:
    parts = total.reshape(CHUNKS, -1)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(CHUNKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
        names=["chunk", "sums"],
    )


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, index = np.zeros((ROWS + 1) * WIDTH), index_vectors()
    border = np.array([ROWS])  # a row of its own between two documents, which has no index vector
    index = tuple(np.vstack([part, np.zeros((1, NONZERO), part.dtype)]) for part in index)
    held, size = [border], 0
    for batch in batches:
        for text in batch.column("text"):
            held += [rows_of(tokens_of(text.as_py())), border]
            size += len(held[-2])
            if size > GATHERED:
                add_contexts(total, np.concatenate(held), index)
                held, size = [border], 0
    add_contexts(total, np.concatenate(held), index)
    yield _chunked(total[: ROWS * WIDTH])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, part in zip(batch.column("chunk").to_pylist(), batch.column("sums"), strict=True):
            part = np.frombuffer(part.as_buffer())
            sums[chunk] = sums[chunk] + part if chunk in sums else part.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
        names=["chunk", "sums"],
    )


def word_vectors(documents: DataFrame) -> np.ndarray:
    """The table of unit vectors, ROWS x WIDTH, from all texts.

    Tasks' tables are whole numbers, summed chunk by chunk in two rounds; the order of the
    sum does not matter. What reaches the driver has the size of one table.
    """
    kind = "chunk int, sums binary"
    sums = documents.select(F.col("text").cast("string").alias("text")).mapInArrow(_gather, kind)
    share = F.pmod(F.xxhash64("sums"), F.lit(16))
    sums = sums.repartition(F.col("chunk"), share).mapInArrow(_add_up, kind)
    sums = sums.repartition("chunk").mapInArrow(_add_up, kind)
    total = np.zeros((CHUNKS, ROWS * WIDTH // CHUNKS))
    for r in sums.collect():
        total[r.chunk] += np.frombuffer(bytes(r.sums))
    table_ = total.reshape(ROWS, WIDTH)
    size = np.sqrt((table_**2).sum(axis=1, keepdims=True))
    return (table_ / np.where(size > 0, size, 1)).astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """The input of the network for one document."""
    text = text or ""
    tokens = tokens_of(text)
    n = len(tokens)
    if not n:
        return np.zeros(vectors.shape[1] + 8, np.float32)
    rows = rows_of(tokens)
    taken, times = np.unique(rows, return_counts=True)
    mean = times.astype(np.float32) @ vectors[taken] / n
    lines = [x for x in text.split("\n") if x]
    raw = text.encode()
    letters = len(raw.translate(None, b"0123456789 \t\r\n!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    capitals = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    words = max(1, raw.count(b" ") + raw.count(b"\n") + 1)
    shares = [
        np.log1p(n) / 10,
        len(taken) / n,
        len(taken) / np.sqrt(n),
        np.count_nonzero(rows[1:] == rows[:-1]) / n,
        len(set(lines)) / max(1, len(lines)),
        1 - letters / max(1, len(raw)),
        capitals / max(1, letters),
        n / words,
    ]
    return np.concatenate([mean, np.array(shares, np.float32)])


@dataclass
class Network:
    """Hidden layer, output and temperature over standardised inputs."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def chances(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def train(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on four fifths of the rows; the temperature with the least loss on the others."""
    dice = np.random.default_rng(11)
    order = dice.permutation(len(x))
    checked, used = order[: len(x) // 5], order[len(x) // 5 :]
    net = Network(
        x[used].mean(axis=0), x[used].std(axis=0) + 1e-3,
        dice.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
        dice.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0,
    )
    moments = {k: [0.0, 0.0] for k in ("w1", "b1", "w2", "b2")}
    step = 0
    for _ in range(EPOCHS):
        for part in np.array_split(dice.permutation(used), max(1, len(used) // BATCH)):
            z = (x[part] - net.mean) / net.scale
            hidden = np.tanh(z @ net.w1 + net.b1)
            wrong = (1 / (1 + np.exp(-np.clip(hidden @ net.w2 + net.b2, -500, 500))) - y[part]) / len(part)
            inner = wrong[:, None] * net.w2 * (1 - hidden**2)
            slopes = {
                "w1": z.T @ inner + 1e-4 * net.w1, "b1": inner.sum(axis=0),
                "w2": hidden.T @ wrong + 1e-4 * net.w2, "b2": wrong.sum(),
            }
            step += 1
            for name, slope in slopes.items():
                m = moments[name]
                m[0], m[1] = 0.9 * m[0] + 0.1 * slope, 0.999 * m[1] + 0.001 * slope**2
                move = 0.003 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, getattr(net, name) - move)
    if len(checked):
        logits = net.logits(x[checked])
        net.temperature = float(min(np.geomspace(0.25, 8, 60), key=lambda t: _loss(logits / t, y[checked])))
    return net


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _features(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = [pooled(t.as_py(), shared.value).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(inputs, pa.binary())], names=["quality", "x"])

    return run


def fit(documents: DataFrame, labels: DataFrame, shared) -> tuple[Network | None, float]:
    """The network, and the share of good labels for when there is no network."""
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAINED)
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    labelled = source.join(F.broadcast(sample), "doc_id")  # at most TRAINED labels
    # Rows that share an id are one example, that with the least hash, so TRAINED bounds them too.
    least = F.min_by(F.struct("text", "quality"), F.xxhash64("text")).alias("row")
    labelled = labelled.groupBy("doc_id").agg(least).select("row.text", "row.quality")
    rows = labelled.mapInArrow(_features(shared), "quality int, x binary").collect()
    rows.sort(key=lambda r: (bytes(r.x), r.quality))  # the same model, whatever the order of tasks
    good = sum(r.quality == 1 for r in rows)
    share = (good + 1) / (len(rows) + 2)
    if not 0 < good < len(rows):
        return None, share
    x = np.array([np.frombuffer(bytes(r.x), np.float32) for r in rows], float)
    return train(x, np.array([r.quality == 1 for r in rows], float)), share


def _score(vectors, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, share = model.value
        for batch in batches:
            row = batch.column("row")
            if net is None or not batch.num_rows:
                scores = np.full(batch.num_rows, share)
            else:
                x = np.array([pooled(t.as_py(), vectors.value) for t in row.field("text")], float)
                scores = net.chances(x)
            yield pa.RecordBatch.from_arrays([row, pa.array(scores, pa.float64())], names=["row", "score"])

    return run


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """row (all columns of a document) and score, the chance of a good label.

    documents: doc_id, text; labels: doc_id, quality.
    """
    context = documents.sparkSession.sparkContext
    vectors = context.broadcast(word_vectors(documents))
    net, share = fit(documents, labels, vectors)
    model = context.broadcast((net, share))
    whole = documents.select(F.struct("*").alias("row"))
    schema = StructType([StructField("row", whole.schema["row"].dataType), StructField("score", DoubleType())])
    return whole.mapInArrow(_score(vectors, model), schema)


def op10_quality(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality_scores(documents, table(spark, folder, "labels"))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= ACCEPTED, 1).otherwise(0).alias("predicted"),
    )


def good_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with their columns."""
    return quality_scores(documents, labels).where(F.col("score") >= ACCEPTED).select("row.*")

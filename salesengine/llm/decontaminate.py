"""Benchmark decontamination by a prefix-filtered set join.

A window is ``size`` consecutive words of a benchmark item, or the whole of a shorter one. A
document contains a window only if it contains all its words, so of the words, ordered by
their document frequency over all documents, the rarest one is a sufficient prefix. Each
place of such a word in a document fixes where the window would start; it must fit into the
document, and then its words are compared exactly.

The windows are taken in blocks of bounded size, each broadcast in turn; every document meets
every block. Null and empty texts have no words. Items without words have no windows; items
without an id mark words but are not listed. Rows of documents stay one by one, with all
their columns inside ``row``, so that repeated ids and clashing names do no harm.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from salesengine.llm.common import table
from salesengine.session import materialize

#: Bytes of windows that are broadcast at a time.
BLOCK_BYTES = 32 << 20

_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of a-z, 0-9 and anything beyond ASCII, in UTF-8."""
    return (text or "").encode().translate(_WORDS).split()


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text")), strict=True):
                words = words_of(text)
                found = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}
                found = sorted(found - {b""})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(found, pa.binary())],
                    names=["item_id", "words"],
                )

    return run


def _frequencies(vocabulary: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(vocabulary.intersection(words_of(text.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    return run


class PrefixIndex:
    """Windows by their rarest word: word -> (offset, length) -> words -> items."""

    def __init__(self, windows: dict[bytes, list[int]], frequency: dict[bytes, int]):
        self.places: dict[bytes, dict[tuple[int, int], dict[bytes, list[int]]]] = {}
        for window, items in windows.items():
            words = window.split(b" ")
            if not all(w in frequency for w in words):
                continue  # a word that no document has
            at = min(range(len(words)), key=lambda i: (frequency[words[i]], words[i], i))
            shapes = self.places.setdefault(words[at], defaultdict(dict))
            shapes[at, len(words)][window] = items

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Places of windows in a document, as word spans, and the items they belong to."""
        spans, items = set(), set()
        places, n = self.places, len(words)
        for position in [i for i, w in enumerate(words) if w in places]:
            for (offset, length), windows in places[words[position]].items():
                start = position - offset
                if start < 0 or start + length > n:
                    continue
                found = windows.get(b" ".join(words[start : start + length]))
                if found is not None:
                    spans.add((start, start + length))
                    items.update(found)
        return sorted(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_FOUND = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<bigint>"


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: PrefixIndex = index.value
        for batch in batches:
            counts, all_spans, all_items = [], [], []
            row = batch.column("row")
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for text, (spans, items) in zip(row.field("text"), before, strict=True):
                words = words_of(text.as_py())
                new_spans, new_items = places.search(words)
                counts.append(len(words))
                spans = [(s["start"], s["end"]) for s in spans]
                all_spans.append(merged(spans + new_spans) if new_spans else spans)
                all_items.append(sorted(new_items.union(items)))
            all_spans = [[{"start": s, "end": e} for s, e in spans] for spans in all_spans]
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(counts, pa.int64()), pa.array(all_spans, pa.list_(_SPAN)), pa.array(all_items, pa.list_(pa.int64()))],
                names=["row", "n_words", "spans", "items"],
            )

    return run


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """row (all columns of a document), n_words, spans (merged, of word positions) and items.

    documents: text; benchmark: item_id, text.
    """
    spark = documents.sparkSession
    windows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        _windows(size), "item_id long, words binary"
    )
    windows = materialize(windows.distinct())
    total = windows.agg(F.sum(F.length("words") + 64)).first()[0] or 0
    blocks = int(total // BLOCK_BYTES) + 1
    empty = StructType.fromDDL(_FOUND)
    found = documents.select(
        F.struct("*").alias("row"),
        *[F.lit(0).cast("long").alias("n_words")],
        *[F.array().cast(empty[c].dataType).alias(c) for c in ("spans", "items")],
    )
    schema = StructType([StructField("row", found.schema["row"].dataType), *empty])
    for block in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("words", "item_id"), F.lit(blocks)) == block).collect()
        members: dict[bytes, list[int]] = defaultdict(list)
        for r in rows:
            members[bytes(r.words)].extend([] if r.item_id is None else [r.item_id])
        vocabulary = {w for window in members for w in window.split(b" ")}
        counted = documents.select("text").mapInArrow(_frequencies(vocabulary), "word binary, n long")
        frequency = {
            bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
        }
        index = spark.sparkContext.broadcast(PrefixIndex(dict(members), frequency))
        found = found.mapInArrow(_search(index), schema)
    return found


def op3_decontaminate(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(documents, table(spark, folder, "benchmark"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The documents that contain no window, with their columns."""
    return contamination(documents, benchmark, size).where(F.size("spans") == 0).select("row.*")

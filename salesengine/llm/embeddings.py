"""Near-duplicate vectors by random hyperplanes, exact cosines and connected components.

The signs of a vector's products with the hyperplanes of a table are its bucket there. Within
a bucket all vectors of one label are compared in double precision, in blocks of bounded
size, and a pair counts in the first table where it meets, so no list of pairs is ever made.
The hyperplanes of a table follow from the number of vectors, so that buckets of vectors
without a near copy keep their size; the tables follow from the chance to miss a pair.

Vectors with a null label or id, that are null, empty or zero, or that hold a null or a
non-finite number, link with nothing; vectors of different lengths neither. Equal vectors of
a label are one class: its members are linked, and only one of them is compared. Rows that
share a vec_id are separate vectors of one vertex of the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesengine.llm.common import (
    BLOCK_MEMBERS,
    connected_components,
    dealt_in_blocks,
    local_roots,
    runs,
    table,
)
from salesengine.session import materialize

#: About so many vectors share a bucket by chance.
SHARED = 16
#: The chance to miss a pair that lies exactly at the threshold.
MISSED = 6e-5
#: What this gives for 65,536 vectors and cosine 0.93, where a sign is shared with 0.8803.
TABLES = 40
BITS = 12


def layout(vectors: int, cosine: float) -> tuple[int, int]:
    """Tables, and hyperplanes of each, for so many vectors."""
    bits = max(1, math.ceil(math.log2(max(1, vectors) / SHARED)))
    met = (1 - math.acos(cosine) / math.pi) ** bits
    return (math.ceil(math.log(MISSED) / math.log1p(-met)) if met < 1 else 1), bits


def _marks_type(bits: int) -> np.dtype:
    return np.dtype("<u2" if bits <= 16 else "<u4" if bits <= 32 else "<u8")


def _unit(vector) -> np.ndarray | None:
    """The vector in double precision at length 1, or None where it links with nothing."""
    if vector is None or not len(vector):
        return None
    x = np.asarray(vector, dtype=np.float64)
    if not np.isfinite(x).all() or not x.any():
        return None
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _planes(width: int, tables: int = TABLES, bits: int = BITS) -> np.ndarray:
    return np.random.default_rng([5, width]).standard_normal((tables * bits, width))


def _prepare(tables: int, bits: int, stored: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors as bytes of their stored type, and the bucket numbers of all tables as bytes."""
        planes: dict[int, np.ndarray] = {}
        weights = (1 << np.arange(bits, dtype=np.uint64)).astype(np.uint64)
        for batch in batches:
            packed, marks = [], []
            for vector in batch.column("embedding").to_pylist():
                unit = _unit(vector)
                packed.append(None if unit is None else np.asarray(vector, stored).tobytes())
                if unit is None:
                    marks.append(None)
                    continue
                if len(unit) not in planes:
                    planes[len(unit)] = _planes(len(unit), tables, bits)
                signs = (planes[len(unit)] @ unit >= 0).reshape(tables, bits)
                marks.append((signs * weights).sum(axis=1).astype(_marks_type(bits)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(packed, pa.binary()), pa.array(marks, pa.binary())],
                names=["id", "label", "packed", "marks"],
            )

    return run


def _units(packed: pa.ChunkedArray, stored: str) -> np.ndarray:
    """Vectors of one length, in double precision at length 1."""
    x = np.array([np.frombuffer(b.as_buffer(), stored) for b in packed.combine_chunks()], np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _compare(cosine: float, bits: int, stored: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per class and pair of blocks: links first met here, weighted, and an id it connects to."""
        for rows in runs(batches, ["key", "lo_block", "hi_block"]):
            if rows.num_rows < 2:
                continue
            ids, weight = rows.column("id").to_numpy(), rows.column("weight").to_numpy()
            vertex = rows.column("vertex").to_numpy()
            block = rows.column("block").to_numpy()
            lo, hi = rows.column("lo_block")[0].as_py(), rows.column("hi_block")[0].as_py()
            here = rows.column("table")[0].as_py()
            units = _units(rows.column("packed"), stored)
            linked = units @ units.T >= cosine
            np.fill_diagonal(linked, False)
            if lo != hi:
                linked &= block[:, None] != block[None, :]
            if not linked.any():
                continue
            marks = np.array([np.frombuffer(b.as_buffer(), _marks_type(bits)) for b in rows.column("marks").combine_chunks()])
            first = linked.copy()
            for before in range(here):
                first &= marks[:, None, before] != marks[None, :, before]
            root = local_roots(first)
            links = first @ weight
            told = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[told]) for x in (ids, links.astype(np.int64), vertex, vertex[root])],
                names=["id", "links", "a", "b"],
            )

    return run


def near_vectors(embeddings: DataFrame, cosine: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``embeddings``.

    embeddings: vec_id, embedding (array of numbers), label. Vectors of one label are linked
    if their cosine is at least ``cosine``. n_links counts the other vectors that a vector is
    linked with, component_id is the smallest vec_id that can be reached, kept marks its rows.
    """
    source = embeddings.select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), "embedding"
    )
    tables, bits = layout(source.count(), cosine)
    stored = "<f4" if source.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"
    prepared = materialize(
        source.mapInArrow(_prepare(tables, bits, stored), "id long, label string, packed binary, marks binary")
    )
    valid = prepared.where("id is not null and label is not null and packed is not null")
    classes = materialize(
        valid.groupBy("label", "packed").agg(
            F.min("id").alias("rep"), F.count("*").alias("weight"), F.any_value("marks").alias("marks")
        ).withColumn("id", F.xxhash64("label", "packed"))
    )
    size = _marks_type(bits).itemsize
    codes = F.expr(
        f"transform(sequence(0, {tables - 1}), t -> named_struct('table', t, 'key', "
        f"xxhash64(label, t, length(packed), substring(marks, {size} * t + 1, {size}))))"
    )
    keyed = classes.select("id", F.explode(codes).alias("k")).select("id", "k.table", "k.key")
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = buckets.select("key", F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int").alias("blocks"))
    rows = keyed.join(buckets, "key").join(
        classes.select("id", F.col("rep").alias("vertex"), "weight", "marks", "packed"), "id"
    )
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int"))
    found = materialize(
        dealt_in_blocks(rows).mapInArrow(_compare(cosine, bits, stored), "id long, links long, a long, b long")
    )
    links = found.groupBy(F.col("id").alias("class")).agg(F.sum("links").alias("links"))
    classed = valid.join(
        classes.select("label", "packed", "rep", "weight", F.col("id").alias("class")), ["label", "packed"]
    ).select("id", "class", "rep", "weight")
    copies = classed.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    edges = found.select("a", "b").unionByName(copies)
    component = connected_components(edges)
    counted = classed.join(links, "class", "left").select(
        "id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    rest = prepared.where("id is null or label is null or packed is null").select(
        "id", F.lit(0).cast("long").alias("n_links")
    )
    every = counted.unionByName(rest).join(component.withColumnRenamed("id", "vertex"), F.col("id") == F.col("vertex"), "left")
    reached = F.coalesce("component", "id")
    return every.select(
        F.col("id").alias("vec_id"),
        "n_links",
        reached.alias("component_id"),
        F.coalesce(reached == F.col("id"), F.lit(False)).alias("kept"),
    )


def op5_embedding_dedup(spark, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))

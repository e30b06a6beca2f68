"""Product codes of vectors, with codebooks fitted by Lloyd rounds over cover trees.

Components become whole numbers, floor(1024 * x), and vectors are cut into four parts. The
rows are stored once in chunks; for each part of a chunk a cover tree is built: every node is
a vector that covers its subtree within a radius, its children lie more than half that radius
apart, and a subtree is one run of the chunk's rows, so that running totals give its sum and
count. In a round, a node whose nearest entry is nearer than any other by more than twice its
radius gives its whole subtree to that entry, by the triangle inequality. Nodes in doubt
descend; leaves in doubt compare exactly, in whole numbers. The result is that of comparing
every vector with every entry, ties included, whatever the chunks are.

Each round sends sums and counts per entry, whose number is fixed, and needs no vector moved.
The trees are written once, so a lost executor costs a re-read.

Rows whose vector is null or holds a null or a component that is not finite are dropped. Parts
have a fourth of the longest vector's length, rounded up; shorter vectors end in zeros, and so
does an empty one. Scaled components are held within 2 ** 22 on both sides, so that distances
of up to 128 components per part are exact in doubles. With fewer rows than entries, the
codebook has as many entries as rows. Repeated ids stay one by one and seed the codebook in
the order of their components; null ids come last. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesengine.llm.common import table
from salesengine.session import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMIT = 1 << 22
#: Rows of one cover tree, and rows of a node that is not divided any more.
CHUNK, LEAF = 4096, 8
#: Distances are roots in doubles; a bound must hold by this much more.
MARGIN = 1e-3


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label string, x array<int>) of the rows that are kept."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    clipped = F.transform(
        x, lambda v: F.floor(F.greatest(F.lit(-1.0 * LIMIT), F.least(F.lit(1.0 * LIMIT), v * SCALE))).cast("int")
    )
    return vectors.where(x.isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        clipped.alias("x"),
    )


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances; whole numbers in doubles, exact."""
    return (points**2).sum(1)[:, None] - 2 * (points @ entries.T) + (entries**2).sum(1)[None, :]


class CoverTree:
    """Nodes over rows that are ordered so that each subtree is one run of them."""

    def __init__(self, points: np.ndarray):
        """points: (rows, width) doubles that hold whole numbers."""
        order: list[np.ndarray] = []
        nodes: list[list] = []  # centre, first row, row behind the last, radius, first child, children
        self._grow(points, order, nodes)
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.points = points[self.order]
        places = np.empty(len(points), np.int64)
        places[self.order] = np.arange(len(points))
        table_ = np.array(nodes, float).reshape(-1, 6)
        self.centre = places[table_[:, 0].astype(np.int64)] if len(nodes) else np.zeros(0, np.int64)
        self.low, self.high, self.child, self.children = table_[:, [1, 2, 4, 5]].astype(np.int64).T
        self.radius = table_[:, 3]
        self.upto = np.vstack([np.zeros((1, points.shape[1])), np.cumsum(self.points, axis=0)])

    @staticmethod
    def _grow(points: np.ndarray, order: list, nodes: list) -> None:
        """Level by level, so that the children of a node stand side by side."""
        if not len(points):
            return
        away = np.sqrt(((points - points[0]) ** 2).sum(1))
        level = [(0, np.arange(len(points)), float(away.max()))]
        nodes.append([0, 0, len(points), level[0][2], 0, 0])
        held = {0: level[0][1]}
        at = 0
        while at < len(nodes):
            centre, low, high, radius = nodes[at][:4]
            rows = held.pop(at)
            if len(rows) > LEAF and radius > 0:
                groups = CoverTree._net(points, rows, centre, radius / 2)
                nodes[at][4:] = len(nodes), len(groups)
                for middle, members, reach in groups:
                    held[len(nodes)] = members
                    nodes.append([middle, low, low + len(members), reach, 0, 0])
                    low += len(members)
            else:
                held[at] = rows
            at += 1
        leaves = sorted((nodes[i][1], i) for i in held)
        order += [held[i] for _, i in leaves]

    @staticmethod
    def _net(points: np.ndarray, rows: np.ndarray, centre: int, reach: float) -> list:
        """Centres more than ``reach`` apart, each with the rows that it covers first."""
        groups, middle = [], centre
        while len(rows):
            away = np.sqrt(((points[rows] - points[middle]) ** 2).sum(1))
            near = away <= reach
            groups.append((middle, rows[near], float(away[near].max())))
            rows = rows[~near]
            middle = int(rows[0]) if len(rows) else -1
        return groups

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entry of each ordered row, sums and counts per entry), ties to the lower entry."""
        chosen = np.zeros(len(self.points), np.int64)
        sums, counts = np.zeros(entries.shape), np.zeros(len(entries), np.int64)
        front = np.zeros(min(1, len(self.low)), np.int64)
        while len(front):
            square = squares(self.points[self.centre[front]], entries)
            nearest = square.argmin(1)
            lines = np.arange(len(front))
            first = np.sqrt(square[lines, nearest])
            square[lines, nearest] = np.inf
            second = np.sqrt(square.min(1))
            sure = second - first > 2 * self.radius[front] + MARGIN
            for node, entry in zip(front[sure].tolist(), nearest[sure].tolist(), strict=True):
                low, high = self.low[node], self.high[node]
                chosen[low:high] = entry
                sums[entry] += self.upto[high] - self.upto[low]
                counts[entry] += high - low
            doubt = front[~sure]
            inner = doubt[self.children[doubt] > 0]
            leaves = doubt[self.children[doubt] == 0]
            if len(leaves):
                rows = np.concatenate([np.arange(self.low[n], self.high[n]) for n in leaves])
                found = squares(self.points[rows], entries).argmin(1)
                chosen[rows] = found
                np.add.at(sums, found, self.points[rows])
                counts += np.bincount(found, minlength=len(entries))
            front = np.concatenate([np.arange(self.child[n], self.child[n] + self.children[n]) for n in inner] or [front[:0]])
        return chosen, sums, counts

    FIELDS = ("order", "points", "centre", "low", "high", "child", "children", "radius")

    def packed(self) -> dict[str, bytes]:
        kinds = {"points": np.int32, "radius": np.float64}
        return {f: getattr(self, f).astype(kinds.get(f, np.int32)).tobytes() for f in self.FIELDS}

    @classmethod
    def unpacked(cls, held: dict[str, bytes], width: int) -> CoverTree:
        tree = cls.__new__(cls)
        for f in cls.FIELDS:
            values = np.frombuffer(held[f], np.float64 if f == "radius" else np.int32)
            setattr(tree, f, values if f == "radius" else values.astype(np.int64))
        tree.points = tree.points.reshape(-1, width).astype(float)
        tree.upto = np.vstack([np.zeros((1, width)), np.cumsum(tree.points, axis=0)])
        return tree


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of ints, filled with zeros up to the width of all parts."""
    out = np.zeros((len(column), PARTS * width))
    lengths = np.diff(column.offsets.to_numpy())
    rows = np.repeat(np.arange(len(column)), lengths)
    places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[rows, places] = column.flatten().to_numpy()
    return out


_TREE = pa.struct([(f, pa.binary()) for f in CoverTree.FIELDS])
_TREES = "ids array<bigint>, labels array<string>, trees array<struct<{}>>".format(
    ", ".join(f"`{f}`: binary" for f in CoverTree.FIELDS)
)


def _plant(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                whole = _matrix(part.column("x"), width)
                trees = [CoverTree(whole[:, i * width : (i + 1) * width]).packed() for i in range(PARTS)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([part.column("label").to_pylist()], pa.list_(pa.string())),
                        pa.array([trees], pa.list_(_TREE)),
                    ],
                    names=["ids", "labels", "trees"],
                )

    return run


def _trees(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, list[CoverTree]]]:
    for i in range(batch.num_rows):
        yield i, [CoverTree.unpacked(t, width) for t in batch.column("trees")[i].as_py()]


def _gather(shared, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sums, counts = np.zeros(books.shape), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for _, trees in _trees(batch, width):
                for part, tree in enumerate(trees):
                    _, s, c = tree.assign(books[part])
                    sums[part] += s
                    counts[part] += c
        part, entry = np.nonzero(counts)
        for place in range(width):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    pa.array(entry, pa.int32()),
                    pa.array(np.full(len(part), place), pa.int32()),
                    pa.array(sums[part, entry, place].astype(np.int64)),
                    pa.array(counts[part, entry]),
                ],
                names=["part", "entry", "place", "total", "n"],
            )

    return run


def _encode(shared, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            for i, trees in _trees(batch, width):
                n = len(batch.column("ids")[i])
                codes, errors = np.zeros((n, PARTS), np.uint8), np.zeros(n)
                for part, tree in enumerate(trees):
                    chosen, _, _ = tree.assign(books[part])
                    codes[tree.order, part] = chosen
                    errors[tree.order] += ((tree.points - books[part][chosen]) ** 2).sum(1)
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(batch.column("ids")[i].as_py(), pa.int64()),
                        pa.array(batch.column("labels")[i].as_py(), pa.string()),
                        pa.array([text[j : j + 2 * PARTS] for j in range(0, len(text), 2 * PARTS)], pa.string()),
                        pa.array(errors.astype(np.int64)),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row, and the codebooks, part by entry by place.

    The driver holds the codebooks, which have ENTRIES entries of a fourth of a vector.
    """
    spark = vectors.sparkSession
    kept = materialize(whole_vectors(vectors))
    longest = kept.agg(F.max(F.size("x")).alias("n")).first().n or 0
    width = max(1, -(-longest // PARTS))
    seeds = kept.select("vec_id", "x").orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).collect()
    books = np.zeros((len(seeds), PARTS * width))
    for row, seed in zip(books, seeds, strict=True):
        row[: len(seed.x)] = seed.x
    books = books.reshape(len(seeds), PARTS, width).transpose(1, 0, 2).copy()
    trees = materialize(kept.mapInArrow(_plant(width), _TREES))
    for _ in range(rounds if seeds else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = trees.mapInArrow(_gather(shared, width), "part int, entry int, place int, total long, n long")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():  # at most PARTS * ENTRIES * width rows
            books[r.part, r.entry, r.place] = r.total // r.n
        shared.unpersist()
    shared = spark.sparkContext.broadcast(books)
    codes = trees.mapInArrow(_encode(shared, width), "vec_id long, label string, code string, error long")
    return codes, books


def decompress(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, vector): the vector that each code stands for."""
    shared = codes.sparkSession.sparkContext.broadcast(books / SCALE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = "".join(batch.column("code").to_pylist())
            chosen = np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, PARTS)
            found = np.concatenate([shared.value[p][chosen[:, p]] for p in range(PARTS)], axis=1)
            vectors = pa.array(list(found), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), vectors], names=["vec_id", "vector"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id long, vector array<double>")


def op13_vector_codes(spark, folder: str) -> DataFrame:
    codes, books = compress(table(spark, folder, "embeddings"))
    codes = materialize(codes)
    listed = ",".join(str(int(v)) for v in books.ravel())
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    joined = codes.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    digest = hashlib.sha256(listed.encode()).hexdigest()
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))

"""Helpers that several operators share: runs of sorted rows, blocks of buckets, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesengine.session import materialize

#: A bucket is cut into blocks of about this many members, and of about this many units of weight.
BLOCK_MEMBERS = 512
BLOCK_WEIGHT = 1 << 21


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crossing_buckets(members: DataFrame) -> DataFrame:
    """Buckets with two members or more, each set of members once.

    members: key long, id long, weight long. The result has key and ``blocks``, the number of blocks that the bucket is cut into. Buckets with the same members (equal
    count, extremes and sums of both halves of a hash over all ids) are kept once.
    """
    mark = F.xxhash64("id")
    found = (
        members.groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.sum(F.col("weight").cast("double")).alias("weight"),
            F.min("id").alias("lo"),
            F.max("id").alias("hi"),
            F.sum(mark.bitwiseAND(F.lit(0xFFFFFFFF))).alias("h1"),
            F.sum(F.shiftrightunsigned(mark, 32)).alias("h2"),
        )
        .where("n > 1")
    )
    once = found.groupBy("n", "lo", "hi", "h1", "h2").agg(
        F.min("key").alias("key"), F.max("weight").alias("weight")
    )
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_WEIGHT))
    return once.select("key", F.greatest(F.lit(1), blocks).cast("int").alias("blocks"))


def dealt_in_blocks(members: DataFrame) -> DataFrame:
    """Rows of a bucket, dealt to pairs of its blocks, so that each two rows meet somewhere.

    members: key, blocks, id and what the comparison needs. A bucket of one block goes out
    as it is; of b blocks each row goes out b times. Rows of one pair stand together in a
    partition, ordered; no pair holds more than about two blocks.
    """
    block = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("int")
    out = members.withColumn("_block", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    out = out.withColumns(
        {"lo_block": F.least("_block", "_other"), "hi_block": F.greatest("_block", "_other")}
    ).drop("_block", "_other", "blocks")
    return out.repartition("key", "lo_block", "hi_block").sortWithinPartitions(
        "key", "lo_block", "hi_block", "id"
    )


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows that stand together and agree in the integer columns ``keys``, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        cuts = np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1
        if held and (columns[:, 0] != last).any():
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts:
            held.append(batch.slice(start, cut - start))
            yield pa.Table.from_batches(held)
            held, start = [], cut
        held.append(batch.slice(start))
        last = columns[:, -1]
    if held:
        yield pa.Table.from_batches(held)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the first row that it is connected with."""
    n = len(linked)
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        reached = np.zeros(n, dtype=bool)
        fresh = np.zeros(n, dtype=bool)
        fresh[start] = True
        while fresh.any():
            reached |= fresh
            fresh = linked[fresh].any(axis=0) & ~reached
        root[reached] = start
    return root


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has an edge.

    edges: a long, b long. Alternates large-star and small-star steps over a written table of
    edges until it no longer changes. A step sends at most one row per vertex and task into
    its aggregate, and joins on the rest, where Spark splits hot vertices.
    """
    pairs = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = materialize(pairs.distinct())
    state = None
    while True:
        seen = current.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if (seen.n, seen.x) == state:
            break
        state = (seen.n, seen.x)
        if not seen.n:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = current.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b"))
        large = large.distinct()
        small = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(small, F.col("a") == F.col("u")).where("b <> m")
        current = materialize(
            moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
    stars = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("id"), "component").distinct())

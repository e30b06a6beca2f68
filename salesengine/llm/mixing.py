"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns.

A document belongs to one source or to several; the set of its sources is its pattern. The
documents are aggregated by pattern, so the flow sees sizes and no documents. Every source
gets a quota: its weight's share of the wanted words, held at ``most`` times what the source
has, the excess shared again by weight among the others. A pattern can send its size to its
sources once at no cost, a second time at cost 1, a third time at cost 2 and so on: the
cheapest largest flow repeats words only where fresh ones cannot fill the quotas. Patterns
that share sources are solved together, each such group in a task of its own.

The flow gives each pattern a number of words: whole rounds of all its documents and a rest.
The rest is filled in a seeded order of the documents. Where it ends is found by counting
words per bin of that order, bin by bin more finely; the gap that the next document would
overshoot goes to the largest document that fits it. No document is taken more than ``most``
times, and no rows are sorted or gathered by source.

Null and empty texts have size 0 and take nothing. A null source, an empty array and a null
array are the null source, the last one; null elements count as it too. Repeated rows stay
one by one and are drawn one by one: rows that agree in id and size are told apart by their
place in the stored table. Reruns agree, but for which of such equal rows is taken. Other
columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesengine.llm.common import connected_components, table
from salesengine.operators.ranking import global_rank
from salesengine.session import materialize

WEIGHTS, PERCENT, MOST, SEED = (5, 2, 1), 150, 2, 42
#: Bits of the seeded order that one round of counting tells apart, and all its bits.
STEP, ORDER_BITS = 12, 60


def n_words(text: Column) -> Column:
    """Runs without space, tab, line feed, vertical tab, form feed or carriage return."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """sizes: source string, size long. Adds ``id`` (its place by code point) and ``target``.

    ``percent`` of the sources' words (a shared document counts in each) are shared by weight;
    the weights repeat in the order of the sources. What a source cannot hold is shared by weight again until none is above.
    """
    ranked = global_rank(sizes, [F.asc_nulls_last("source")], "id")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.get(listed, F.pmod(F.col("id") - 1, F.lit(len(weights))).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight))
    wanted = (ranked.agg(F.sum("size")).first()[0] or 0) * percent / 100
    level, held = 0.0, -1
    full = F.col("size") * float(most)
    while True:  # a source that is full stays full, so at most one round per source
        above = F.col("weight") * level > full
        open_ = F.when(~above, F.col("weight"))
        now = ranked.agg(
            F.count_if(above).alias("n"), F.sum(F.when(above, full)).alias("full"), F.sum(open_).alias("weight")
        ).first()
        if now.n == held or not now.weight:
            break
        held, level = now.n, (wanted - (now.full or 0)) / now.weight
    target = F.least(F.col("weight") * level, full) if now.weight else full
    return ranked.select("source", "size", "id", target.cast("double").alias("target"))


def min_cost_flow(sizes: list[int], members: list[list[int]], quotas: list[int], most: int) -> list[list[int]]:
    """Words that each pattern sends to each of its sources.

    Successive cheapest paths from patterns over sources to quotas. Repetition k of a pattern
    costs k, on its first arc alone, and the costs are convex; so the cheapest path starts at
    a pattern that has been repeated least, and later steps only move words between sources.
    """
    flow = [[0] * len(m) for m in members]
    users = [[] for _ in quotas]
    for p, of in enumerate(members):
        for i, s in enumerate(of):
            users[s].append((p, i))
    left = list(quotas)
    for _ in range(most):  # the costs 0, 1, 2 …
        spare = list(sizes)
        stuck = set()
        for start in range(len(sizes)):
            while spare[start] and start not in stuck:
                came: dict[int, tuple[int, int, int] | None] = {}  # source: pattern, its arc, source before
                queue, goal = deque(), None
                for i, s in enumerate(members[start]):
                    if s not in came:
                        came[s] = (start, i, -1)
                        queue.append(s)
                while queue and goal is None:
                    s = queue.popleft()
                    if left[s]:
                        goal = s
                        break
                    for p, i in users[s]:  # words that p sends here can go to its other sources
                        if flow[p][i]:
                            for k, other in enumerate(members[p]):
                                if other not in came:
                                    came[other] = (p, k, s)
                                    queue.append(other)
                if goal is None:
                    stuck.add(start)
                    break
                path, s = [], goal
                while s >= 0:
                    p, k, before = came[s]
                    path.append((p, k, before))
                    s = before
                amount = min(spare[start], left[goal])
                for p, _, before in path:
                    if before >= 0:
                        amount = min(amount, flow[p][members[p].index(before)])
                for p, k, before in path:
                    flow[p][k] += amount
                    if before >= 0:
                        flow[p][members[p].index(before)] -= amount
                spare[start] -= amount
                left[goal] -= amount
    return flow


def _solve(most: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("pattern", key=lambda c: c.map(tuple))
        wanted = {s: t for ids, ts in zip(group["pattern"], group["targets"], strict=True) for s, t in zip(ids, ts, strict=True)}
        place = {s: i for i, s in enumerate(sorted(wanted))}
        members = [[place[s] for s in ids] for ids in group["pattern"]]
        quotas = [round(wanted[s]) for s in sorted(wanted)]
        flow = min_cost_flow([int(n) for n in group["size"]], members, quotas, most)
        return pd.DataFrame({"pattern": group["pattern"], "size": group["size"], "flow": flow})

    return run


def pattern_flows(patterns: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """(pattern, size, flow): the words that each pattern sends to each of its sources.

    patterns: pattern array<long> of source ids in order, size long. Sources that some
    pattern joins are one group.
    """
    joined = patterns.where(F.size("pattern") > 1).select(
        F.element_at("pattern", 1).alias("a"), F.explode("pattern").alias("b")
    )
    groups = connected_components(joined).select("id", "component")
    each = patterns.select("pattern", "size", F.posexplode("pattern").alias("i", "id"))
    each = each.join(targets.select("id", "target"), "id")
    with_targets = each.groupBy("pattern").agg(
        F.first("size").alias("size"), F.array_sort(F.collect_list(F.struct("i", "target"))).alias("t")
    )
    with_targets = with_targets.select("pattern", "size", F.col("t.target").alias("targets"))
    lead = F.element_at("pattern", 1)
    grouped = with_targets.join(groups, lead == F.col("id"), "left")
    grouped = grouped.select("pattern", "size", "targets", F.coalesce("component", lead).alias("component"))
    kind = "pattern array<long>, size long, flow array<long>"
    return grouped.groupBy("component").applyInPandas(_solve(most), kind)


def filled(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents that fill the rest of their pattern: a column ``extra``, 1 or 0.

    documents: pattern, size, draw long below 2 ** ORDER_BITS. wanted: pattern, rest long.
    The documents of a pattern come in the order of ``draw`` as long as they fit; then the
    largest of the others that fits the gap comes too.
    """
    state = wanted.where("rest > 0").select("pattern", "rest", F.lit(0).cast("long").alias("cut"))
    inside = documents.where("size > 0").select("pattern", "size", "draw")
    for shift in range(ORDER_BITS - STEP, -1, -STEP):
        # cut: all draws below it are taken; rest: words that are left from there on.
        state = materialize(state)
        low = F.shiftright("draw", shift)
        bins = (
            inside.join(state, "pattern")
            .where(F.shiftright("draw", shift + STEP) == F.shiftright("cut", shift + STEP))
            .groupBy("pattern", "rest", "cut", low.alias("bin"))
            .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        )
        upto = Window.partitionBy("pattern").orderBy("bin")  # at most 2 ** STEP bins of a pattern
        summed = materialize(bins.withColumn("upto", F.sum("words").over(upto)))
        reached = summed.groupBy("pattern").agg(
            F.min(F.when(F.col("upto") > F.col("rest"), F.struct("bin", "words", "upto", "n"))).alias("b"),
            F.max("bin").alias("last"),
            F.first("rest").alias("rest"),
            F.max("upto").alias("all"),
        )
        cut = F.coalesce(F.col("b.bin"), F.col("last") + 1)
        before = F.coalesce(F.col("b.upto") - F.col("b.words"), F.col("all"))
        state = materialize(
            reached.select(
                "pattern",
                (F.col("rest") - before).alias("rest"),
                F.shiftleft(cut, shift).alias("cut"),
                F.coalesce(F.col("b.n"), F.lit(0)).alias("n"),
            )
        )
        crowded = (state.agg(F.max("n")).first()[0] or 0) > 1
        state = state.drop("n")
        if not crowded:
            break
    fits = (F.col("draw") >= F.col("cut")) & (F.col("size") <= F.col("rest"))
    last = inside.join(state, "pattern").where(fits).groupBy("pattern").agg(
        F.max(F.struct("size", (-F.col("draw")).alias("draw"))).alias("last")
    )
    state = materialize(state.join(last, "pattern", "left").select("pattern", "cut", (-F.col("last.draw")).alias("also")))
    taken = (F.col("draw") < F.col("cut")) | F.coalesce(F.col("draw") == F.col("also"), F.lit(False))
    extra = F.when((F.col("size") > 0) & taken, 1).otherwise(0)
    joined = documents.join(state, "pattern", "left")
    return joined.withColumn("extra", F.coalesce(extra, F.lit(0)).cast("long")).drop("cut", "also")


def mix(
    documents: DataFrame, sources: str = "sources", weights=WEIGHTS, percent: int = PERCENT,
    most: int = MOST, seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with how often each is taken, the sources, and the flows between them.

    ``sources`` names an array column. The documents come as (doc_id, size, pattern, times,
    taken), the sources as (source, id, size, target), the flows as (pattern, size, flow).
    """
    named = F.when(F.size(sources) > 0, F.array_distinct(sources)).otherwise(
        F.array(F.lit(None).cast("string"))
    )
    rows = materialize(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            n_words(F.col("text").cast("string")).alias("size"),
            F.array_sort(F.coalesce(named, F.array(F.lit(None).cast("string")))).alias("names"),
        )
    )
    by_name = materialize(rows.groupBy("names").agg(F.sum("size").alias("size"), F.count("*").alias("docs")))
    each = by_name.select("names", "size", F.explode("names").alias("source"))
    sizes = each.groupBy("source").agg(F.sum("size").alias("size"))
    targets = materialize(source_targets(sizes, weights, percent, most))
    ids = each.join(targets.select(F.col("source").alias("s"), "id"), F.col("source").eqNullSafe(F.col("s")))
    ids = ids.groupBy("names").agg(F.array_sort(F.collect_list("id")).alias("pattern"))
    ids = materialize(ids)
    same = by_name.withColumnRenamed("names", "n")
    patterns = ids.join(same, F.col("names").eqNullSafe(F.col("n"))).select("pattern", "size")
    flows = materialize(pattern_flows(patterns, targets, most))
    sent = F.aggregate("flow", F.lit(0).cast("long"), lambda a, b: a + b)
    wanted = flows.select("pattern", sent.alias("sent"), F.col("size").alias("all"))
    rounds = F.when(F.col("all") > 0, F.expr("sent div all")).otherwise(0)
    wanted = materialize(wanted.select("pattern", rounds.alias("rounds"), (F.col("sent") - rounds * F.col("all")).alias("rest")))
    # Ids and sizes order the documents; the place tells equal rows apart.
    high = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "size"), 64 - ORDER_BITS + 24)
    place = F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 24) - 1))
    drawn = rows.withColumn("draw", F.shiftleft(high, 24) + place)
    drawn = materialize(drawn.join(ids, drawn["names"].eqNullSafe(ids["names"])).select("doc_id", "size", "pattern", "draw"))
    taken = filled(drawn, wanted).join(wanted.select("pattern", "rounds"), "pattern", "left")
    times = (F.coalesce("rounds", F.lit(0)) + F.col("extra")).cast("long")
    found = taken.select("doc_id", "size", "pattern", times.alias("times"))
    return found.withColumn("taken", F.col("times") * F.col("size")), targets, flows


def op12_mixing(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found, sources, _ = mix(documents.withColumn("sources", F.array("source")))
    sources = sources.select("id", F.col("size").alias("source_size"), "target")
    found = found.withColumn("id", F.element_at("pattern", 1)).join(sources, "id")
    return found.select("doc_id", "size", "source_size", "target", "taken")

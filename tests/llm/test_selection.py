"""Resampling, mixing and vector codes against plain Python, and their edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from salesengine.llm import codes, mixing, resampling
from salesengine.llm.codes import CoverTree, compress, decompress, squares
from salesengine.llm.mixing import min_cost_flow, mix, source_targets
from salesengine.llm.resampling import drawn_documents, gain_planes, gains, resample, weights

# --- resampling -------------------------------------------------------------


def plain_features(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    runs = (" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    return len(words), Counter(crc32(run.encode()) % 10000 for run in runs)


def plain_resample(documents, target):
    read = [(i, *plain_features(text)) for i, text in documents]
    s, t = Counter(), Counter()
    for _, _, found in read:
        s.update(found)
    for text in target:
        t.update(plain_features(text)[1])
    all_s, all_t = s.total() + 10000, t.total() + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    rows = []
    for i, n, found in read:
        weight = sum(gain[b] * k for b, k in found.items())
        name = f"42:{'' if i is None else i}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, n, found.total(), weight, weight + noise, None])
    eligible = [r for r in rows if r[1] >= 20]
    eligible.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for rank, row in enumerate(eligible[: 5 * len(eligible) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, rows), key=repr)


def words(dice, n):
    pool = ["Alpha", "beta", "GAMMA", "délta", "42", "x", "ωmega", "naïve", "the", "of"]
    return dice.choice([" ", ", ", "\n", "--"]).join(dice.choice(pool) for _ in range(n))


def test_resampling_like_plain_python(spark, monkeypatch):
    monkeypatch.setattr(resampling, "BLOCK", 64)  # runs across the borders of blocks
    dice = random.Random(3)
    rows = [(i, words(dice, dice.choice([0, 1, 2, 3, 19, 20, 60, 200]))) for i in range(150)]
    rows += [(None, None), (200, None), (201, ""), (202, "--"), (203, words(dice, 30_000))]
    rows += [(204, "same text " * 20)] * 3 + [(None, "no id at all " * 9), (205, "x" * 5000)]
    target = [words(dice, 40) for _ in range(5)] + [None, "beta of the beta " * 20]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = docs.withColumn("rank", docs.doc_id).withColumn("bucket", docs.text)
    asked = spark.createDataFrame([(t,) for t in target], "text string")
    found = sorted((tuple(r) for r in resample(docs, asked).collect()), key=repr)
    assert found == plain_resample(rows, target)
    kept = drawn_documents(docs, asked)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in found if r[5]}


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 20)] * 20, "doc_id long, text string")
    none = docs.limit(0)
    assert resample(none, docs).collect() == []
    found = resample(docs, none).collect()
    assert len(found) == 20 and [r["rank"] for r in found if r["rank"]] == [1]


def test_planes_give_exact_weights():
    dice = np.random.default_rng(5)
    counts = dice.integers(0, 3, (7, resampling.BUCKETS)).astype(np.int32)
    counts[2, 17] = 2**30
    for low, high in ((-9000, 9000), (0, 1), (-1, 0), (-(2**13), 2**13 + 1)):
        gain = dice.integers(low, high, resampling.BUCKETS)
        assert weights(counts, gain_planes(gain)) == [int(c.astype(object) @ gain) for c in counts]
    assert (gains(np.zeros(10_000), np.zeros(10_000)) == 0).all()


# --- mixing -----------------------------------------------------------------


def plain_targets(sizes, wanted):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(sizes)
    while open_:
        level = (wanted - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        open_ -= full
    return target


def test_targets_like_plain_python(spark):
    sizes = {"b": 100, "a": 10, "ä": 900, "z": 300, None: 50, "c": 1000, "\U0001f600": 7, "d": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in source_targets(rows).collect()}
    expected = plain_targets(sizes, 1.5 * sum(sizes.values()))
    assert found == pytest.approx(expected)
    assert sum(found.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_flow_fills_quotas_and_repeats_least():
    dice = random.Random(7)
    for _ in range(60):
        patterns = [sorted(dice.sample(range(3), dice.randint(1, 3))) for _ in range(dice.randint(1, 3))]
        sizes = [dice.randint(0, 3) for _ in patterns]
        quotas = [dice.randint(0, 4) for _ in range(3)]
        flow = min_cost_flow(sizes, patterns, quotas, 2)
        filled = [sum(flow[p][m.index(s)] for p, m in enumerate(patterns) if s in m) for s in range(3)]
        assert all(f <= q for f, q in zip(filled, quotas, strict=True))
        sent = [sum(f) for f in flow]
        assert all(0 <= a <= 2 * b for a, b in zip(sent, sizes, strict=True))
        assert all(f >= 0 for row in flow for f in row)
        best = (0, 0)  # most words, then least repetition, over all flows
        arcs = [(p, s) for p, m in enumerate(patterns) for s in m]
        for amounts in itertools.product(*[range(min(2 * sizes[p], quotas[s]) + 1) for p, s in arcs]):
            of, to = Counter(), Counter()
            for (p, s), a in zip(arcs, amounts, strict=True):
                of[p] += a
                to[s] += a
            if all(of[p] <= 2 * n for p, n in enumerate(sizes)) and all(to[s] <= q for s, q in enumerate(quotas)):
                cost = sum(max(0, of[p] - n) for p, n in enumerate(sizes))
                best = max(best, (sum(amounts), -cost))
        cost = sum(max(0, a - b) for a, b in zip(sent, sizes, strict=True))
        assert (sum(sent), -cost) == best


def test_mix_of_overlapping_sources(spark):
    dice = random.Random(11)
    rows = []
    for i in range(3000):
        of = dice.choice([["a"], ["b"], ["a", "b"], ["b", "c"], ["c"], ["d"], [None], [], None, ["d", "d"]])
        rows.append((i, "w " * dice.randint(0, 30), of))
    rows += [(9000, "word " * 25, ["hot"])] * 1500 + [(None, None, ["a"]), (9001, "x " * 20_000, ["a", "c"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>").repartition(5)
    docs = docs.withColumn("size", docs.doc_id).withColumn("pattern", docs.text)
    found, sources, flows = mix(docs)
    found, sources, flows = found.collect(), sources.collect(), flows.collect()
    assert sorted((r.doc_id or -1, r.size) for r in found) == sorted(
        (i or -1, len((t or "").split())) for i, t, _ in rows
    )
    assert all(0 <= r.times <= 2 and r.taken == r.times * r.size for r in found)
    targets = {r.id: r.target for r in sources}
    sent = Counter()
    for r in flows:
        for source, words_ in zip(r.pattern, r.flow, strict=True):
            sent[source] += words_
    assert all(sent[s] <= t + 1 for s, t in targets.items())
    short = {s for s, t in targets.items() if sent[s] < t - 1}  # only where nothing is left to take
    assert short < set(targets)
    assert all(sum(r.flow) == 2 * r.size for r in flows if short & set(r.pattern))
    taken, wanted = Counter(), {tuple(r.pattern): sum(r.flow) for r in flows}
    for r in found:
        taken[tuple(r.pattern)] += r.taken
    assert all(abs(taken[p] - w) <= 25 for p, w in wanted.items())
    again = mix(docs.repartition(2))[0].collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in found)


def test_fill_takes_the_seeded_order(spark, monkeypatch):
    """The documents of least draw that fit, then the largest other that fits the gap."""
    monkeypatch.setattr(mixing, "STEP", 4)
    dice = random.Random(13)
    rows = [(p, dice.randint(0, 50), dice.getrandbits(60)) for p in range(4) for _ in range(400)]
    rest = {0: 0, 1: 777, 2: 3, 3: sum(n for p, n, _ in rows if p == 3) - 1}
    docs = spark.createDataFrame([([p], n, d) for p, n, d in rows], "pattern array<long>, size long, draw long")
    wanted = spark.createDataFrame([([p], r) for p, r in rest.items()], "pattern array<long>, rest long")
    found = {(r.pattern[0], r.size, r.draw) for r in mixing.filled(docs, wanted).collect() if r.extra}
    expected = set()
    for p, left in rest.items():
        mine = sorted((r for r in rows if r[0] == p and r[1]), key=lambda r: r[2])
        while left and mine[0][1] <= left:
            left -= mine[0][1]
            expected.add(mine.pop(0))
        fits = [r for r in mine if r[1] <= left]
        if fits:
            expected.add(max(fits, key=lambda r: (r[1], -r[2])))
    assert found == expected


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, sources array<string>")
    assert mix(docs)[0].collect() == []
    empty = spark.createDataFrame([(1, None, ["a"]), (2, "", None)], docs.schema)
    assert sorted((r.doc_id, r.size, r.taken) for r in mix(empty)[0].collect()) == [(1, 0, 0), (2, 0, 0)]


# --- vector codes -----------------------------------------------------------


def plain_codes(rows, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(v is not None and math.isfinite(v) for v in r[1])]
    width = max(1, -(-max(len(r[1]) for r in kept) // 4))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, [math.floor(v * 1024) for v in r[1]]))
    x = np.zeros((len(kept), 4 * width))
    for line, (_, vector, _) in zip(x, kept, strict=True):
        line[: len(vector)] = [math.floor(v * 1024) for v in vector]
    parts = x.reshape(-1, 4, width).transpose(1, 0, 2)
    books = parts[:, :256].copy()
    for turn in range(rounds + 1):
        near = [squares(p, b) for p, b in zip(parts, books, strict=True)]
        chosen = [d.argmin(1) for d in near]
        for p in range(4) if turn < rounds else ():
            for entry in np.unique(chosen[p]):
                books[p, entry] = np.floor(parts[p][chosen[p] == entry].sum(0) / (chosen[p] == entry).sum())
    found = []
    for i, (vec_id, _, label) in enumerate(kept):
        error = int(sum(near[p][i, chosen[p][i]] for p in range(4)))
        found.append((vec_id, label, "".join(f"{chosen[p][i]:02x}" for p in range(4)), error))
    return sorted(found, key=repr), books


@pytest.mark.parametrize("chunk", [50, 4096])
def test_codes_like_plain_python(spark, monkeypatch, chunk):
    monkeypatch.setattr(codes, "CHUNK", chunk)
    dice = np.random.default_rng(17)
    middles = dice.normal(0, 0.4, (30, 16))
    rows = [(i, (middles[i % 30] + dice.normal(0, 0.05, 16)).tolist(), str(i % 3)) for i in range(700)]
    rows += [(1000 + i, middles[4].tolist(), None) for i in range(300)]  # copies, ties
    rows += [(2000, None, "0"), (2001, [None] * 16, "0"), (2002, [math.nan] * 16, "1"), (None, [0.5] * 16, "2")]
    rows += [(2003, [math.inf] * 16, "1"), (2004, [0.25] * 3, "1"), (2005, [], "1"), (5, [0.0] * 16, "1")]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(3)
    found, books = compress(data.withColumn("code", data.label).withColumn("x", data.vec_id))
    expected, plain_books = plain_codes(rows)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected
    assert (books == plain_books).all()
    back = {r.vec_id: r.vector for r in decompress(found, books).collect()}
    errors = {i: e for i, _, _, e in expected}
    for i in (0, 1, 99):
        whole = np.floor(np.array(rows[i][1]) * 1024)
        assert ((np.array(back[i]) * 1024 - whole) ** 2).sum() == errors[i]


def test_codes_of_few_rows_and_none(spark):
    data = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 1e30], 0)], "vec_id long, embedding array<double>, label int")
    found, books = compress(data)
    assert [tuple(r) for r in found.collect()] == [(1, "0", "00000000", 0)]
    assert books[3, 0, 0] == codes.LIMIT
    assert compress(data.limit(0))[0].collect() == []


def test_cover_tree_gives_whole_subtrees():
    """Children lie more than half the radius apart and cover their rows; few rows are compared."""
    dice = np.random.default_rng(19)
    middles = np.round(dice.normal(0, 2000, (12, 16)))
    points = np.round(middles[dice.integers(0, 12, 3000)] + dice.normal(0, 3, (3000, 16)))
    tree = CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(3000))
    for node in range(len(tree.low)):
        rows = tree.points[tree.low[node] : tree.high[node]]
        middle = tree.points[tree.centre[node]]
        assert np.sqrt(((rows - middle) ** 2).sum(1)).max() <= tree.radius[node]
        below = range(tree.child[node], tree.child[node] + tree.children[node])
        centres = tree.points[tree.centre[list(below)]]
        for i, j in itertools.combinations(range(min(40, len(centres))), 2):
            assert ((centres[i] - centres[j]) ** 2).sum() > (tree.radius[node] / 2) ** 2
    compared = []

    def counting(points_, entries):
        compared.append(len(points_))
        return squares(points_, entries)

    codes.squares, kept = counting, codes.squares
    try:
        chosen, sums, counts = tree.assign(middles)
    finally:
        codes.squares = kept
    assert sum(compared) < 300
    exact = squares(tree.points, middles).argmin(1)
    assert (chosen == exact).all() and counts.tolist() == np.bincount(exact, minlength=12).tolist()
    assert (sums == np.array([tree.points[exact == e].sum(0) for e in range(12)])).all()

"""Personal data by candidate spans and boosted trees, in DataFrame functions alone.

Four exact rules give the base spans. Wider generators propose overlapping candidates with
features of their format (digits, groups, separators) and context (words before, the
character after). Boosted trees learn from counts per combination of features over all
documents. A candidate for which a base rule holds is a right example; one for which none
holds is a wrong example only if no word of its kind (call, mail, card, server …) stands before
it. What such a word announces without a rule that holds is no example at all: that is what the
trees are to judge. No feature tells whether a rule holds (not a phone's plus sign, nor the
digits of its country, so digits and groups are counted coarsely), and what is learned carries
over from what the rules find to what is written otherwise in the same places. On a
fifth of the documents a threshold is set for each kind, so that examples above it are right as
often as asked for. Candidates above it join the base spans, which always stay.

The features take few values, so the table of their combinations is bounded (under 60,000
rows) and is all that the driver sees. Null and empty texts have no spans. Rows stay one by
one. Positions are code points. Long matches are consumed in one go, without backtracking.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesengine.llm.common import table
from salesengine.session import materialize

KINDS = ("email", "ip", "card", "phone")

# The base rules, written so that the engine need not backtrack, the character
# that a text must hold for a match, and the generators (kind, pattern, character).
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    # A whole chain of digits, of the lengths that the rule keeps.
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])", ""),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
WHOLE = {
    "email": r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++$",
    "ip": r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$",
    "card": r"^[0-9](?:[\x20-]?[0-9])++$",
    "phone": r"^\+[0-9][\x20().0-9-]+[0-9]$",
}
GENERATORS = (
    ("email", r"(?<![^\s@])[^\s@]++@[^\s@]++", "@"),
    ("ip", r"(?<![0-9.:])[0-9]++(?:[.:][0-9]++){3,}+", ""),
    ("number", r"(?<![0-9])\+?\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+", ""),
)
# Words that announce a kind, in the text before a candidate, and the end of that text.
ANNOUNCED = {
    "email": "mail|e-mail|email|mailto|contact|address",
    "ip": "ip|host|server|address|gateway",
    "card": "card|visa|mastercard|amex|credit|debit",
    "phone": "tel|telephone|phone|fon|telefon|call|mobile|cell|fax|contact",
}
_NEAR = r"[^\n0-9@]{0,12}$"
FEATURES = ("kind", "digits", "paren", "marks", "groups", "tail", "context", "after")
ROUNDS, RATE, LEAST_ROWS = 40, 0.3, 20
PRECISION = 0.97
CHUNK = 256
_SPAN = "struct<start:int,end:int,text:string,before:string,after:string>"


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def spans(text: Column, pattern: str, needs: str) -> Column:
    """Start, end, text, the 24 characters before and the one after of all matches.

    Positions are sums over the pieces between the matches, taken chunk by chunk, since a
    row's array is copied whole for each element that is added to it.
    """
    none = F.array().cast(f"array<{_SPAN}>")
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.split(text, pattern, -1).alias("gaps"),
    )

    def placed(chunk: Column, first: Column) -> Column:
        def step(a: Column, x: Column) -> Column:
            start = a["at"] + F.char_length(x["gap"])
            end = start + F.char_length(x["text"])
            one = F.struct(
                start.alias("start"), end.alias("end"), x["text"].alias("text"),
                F.right(x["gap"], F.lit(24)).alias("before"), F.left(x["next"], F.lit(1)).alias("after"),
            )
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

        return F.aggregate(chunk, F.struct(first.alias("at"), none.alias("out")), step)["out"]

    def cut(p: Column) -> Column:
        count = F.size(p["matches"])

        def piece(k: Column) -> Column:
            return F.struct(
                F.get(p["gaps"], k).alias("gap"), F.get(p["matches"], k).alias("text"), F.get(p["gaps"], k + 1).alias("next")
            )

        firsts = F.sequence(F.lit(0), count - 1, F.lit(CHUNK))
        return F.transform(firsts, lambda i: F.transform(F.sequence(i, F.least(i + CHUNK, count) - 1), piece))

    def size(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0), lambda a, x: a + F.char_length(x["gap"]) + F.char_length(x["text"]))

    def joined(chunks: Column) -> Column:
        def add(a: Column, chunk: Column) -> Column:
            return F.concat(a, F.array(F.element_at(a, -1) + size(chunk)))

        starts = F.slice(F.aggregate(chunks, F.array(F.lit(0)), add), F.lit(1), F.size(chunks))
        return F.flatten(F.zip_with(chunks, starts, placed))

    found = bound(parts, lambda p: F.when(F.size(p["matches"]) > 0, bound(cut(p), joined)).otherwise(none))
    if needs == ".":
        possible = text.rlike(r"[0-9]\.[0-9]")
    else:
        possible = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]")
    return F.when(possible, found).otherwise(none)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _small_parts(text: Column) -> Column:
    plain = F.transform(F.split(text, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(plain, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _luhn(text: Column) -> Column:
    digits = F.reverse(_digits(text))

    def add(total: Column, i: Column) -> Column:
        value = F.substr(digits, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return total + value - F.when(value > 9, 9).otherwise(0)

    right = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0
    return F.when(F.length(digits).between(16, 19), right).otherwise(False)


RULES = {
    "email": lambda t: F.lit(True),
    "ip": _small_parts,
    "card": _luhn,
    "phone": lambda t: F.length(_digits(t)).between(8, 15),
}


def packed(kind: Column, start: Column, end: Column) -> Column:
    """A span as one long: hashed and sorted without objects, by kind, start and end."""
    return (kind.cast("long") * (1 << 30) + start) * (1 << 30) + end


def unpacked(span: Column) -> tuple[Column, Column, Column]:
    """Kind number, start and end."""
    low = F.lit((1 << 30) - 1).cast("long")
    end, start = span.bitwiseAND(low), F.shiftright(span, 30).bitwiseAND(low)
    return F.shiftright(span, 60).cast("int"), start.cast("int"), end.cast("int")


def base_spans(text: Column) -> Column:
    """A struct with the base spans of each kind, packed."""

    def kept(kind: str) -> Column:
        right = F.filter(spans(text, *BASE[kind]), lambda s: RULES[kind](s["text"]))
        number = F.lit(KINDS.index(kind))
        return F.transform(right, lambda s: packed(number, s["start"], s["end"])).alias(kind)

    return F.struct(*map(kept, KINDS))


def candidates(text: Column) -> Column:
    """Generated spans, whether they are right examples (1), wrong ones (0) or none (NULL), and
    features as small integers."""

    def announced(name: str, digits: Column, before: Column) -> Column:
        def by(kind: str) -> Column:
            return before.rlike(rf"(?i)(?<![a-z])(?:{ANNOUNCED[kind]}){_NEAR}")

        return F.when(digits >= 14, by("card")).otherwise(by("phone")) if name == "number" else by(name)

    def described(name: str, s: Column) -> Column:
        t = s["text"]
        digits = F.length(_digits(t))
        seps = F.regexp_replace(t, "[^\\x20().:-]", "")
        before, following = s["before"], s["after"]
        kind = {
            "email": F.lit(0),
            "ip": F.lit(1),
            "number": F.when(digits >= 14, 2).otherwise(3),
        }[name]
        columns = {
            "kind": kind,
            "digits": F.when(digits < 7, 0).when(digits < 16, 1).when(digits < 20, 2).otherwise(3),
            "paren": F.contains(t, F.lit("(")).cast("int"),
            "marks": F.when(seps == "", 0).when(seps.rlike("^[.]+$"), 1).when(seps.rlike("^-+$"), 2).when(seps.rlike("^ +$"), 3).otherwise(4),
            "groups": F.least(F.size(F.filter(F.split(t, "[^0-9]+"), lambda g: g != "")), F.lit(3)),
            "tail": t.rlike(r"\.[A-Za-z]{2,}$").cast("int"),
            "context": announced(name, digits, before).cast("int"),
            "after": F.when(following == "", 0).when(following.rlike(r"\s"), 1).when(following.rlike("[A-Za-z0-9]"), 3).otherwise(2),
        }
        right = F.lit(False)
        for n, k in enumerate(KINDS):
            right = right | ((kind == n) & t.rlike(WHOLE[k]) & RULES[k](t))
        known = F.when(right, 1).when(~announced(name, digits, before), 0)
        return F.struct(
            packed(kind, s["start"], s["end"]).alias("span"), known.alias("right"),
            *[columns[f].cast("int").alias(f) for f in FEATURES],
        )

    parts = []
    for name, pattern, needs in GENERATORS:
        parts.append(F.transform(spans(text, pattern, needs), partial(described, name)))
    return F.concat(*parts)


def detected(text: Column) -> Column:
    plain = F.coalesce(text.cast("string"), F.lit(""))
    return F.struct(base_spans(plain).alias("base"), candidates(plain).alias("candidates"))


# --- boosted trees over the counted combinations of features -----------------------------


@dataclass
class Trees:
    """Depth-two regression trees on feature <= cut, and a threshold of the score per kind."""

    bias: float
    trees: list[tuple]  # (feature, cut, left, right), a leaf is a number
    thresholds: dict[int, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for tree in self.trees:
            out += _value(tree, x)
        return out

    def column(self, candidate: Column) -> Column:
        out = F.lit(self.bias)
        for tree in self.trees:
            out = out + _case(tree, candidate)
        return out

    def accepted(self, candidate: Column) -> Column:
        out = F.lit(False)
        for kind, threshold in self.thresholds.items():
            out = out | ((candidate["kind"] == kind) & (self.column(candidate) >= threshold))
        return out


def _value(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    feature, cut, left, right = tree
    return np.where(x[:, feature] <= cut, _value(left, x), _value(right, x))


def _case(tree, candidate: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    feature, cut, left, right = tree
    return F.when(candidate[FEATURES[feature]] <= cut, _case(left, candidate)).otherwise(_case(right, candidate))


def _grow(x: np.ndarray, slope: np.ndarray, bend: np.ndarray, depth: int):
    """The tree with the largest gain; slope and bend are sums over each combination."""

    def leaf(rows: np.ndarray) -> float:
        return RATE * float(slope[rows].sum() / (bend[rows].sum() + 1))

    every = np.ones(len(x), bool)
    if not depth:
        return leaf(every)
    best, chosen = 1e-6, None
    whole = slope.sum() ** 2 / (bend.sum() + 1)
    for feature in range(x.shape[1]):
        for cut in np.unique(x[:, feature])[:-1]:
            left = x[:, feature] <= cut
            gain = slope[left].sum() ** 2 / (bend[left].sum() + 1) + slope[~left].sum() ** 2 / (bend[~left].sum() + 1) - whole
            if gain > best:
                best, chosen = gain, (feature, cut, left)
    if chosen is None:
        return leaf(every)
    feature, cut, left = chosen
    sides = [_grow(x[s], slope[s], bend[s], depth - 1) for s in (left, ~left)]
    return (feature, int(cut), *sides)


def boost(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> Trees:
    """Gradient boosting of the log loss on weighted combinations."""
    weight = good + bad
    bias = float(np.log((good.sum() + 1) / (bad.sum() + 1)))
    model = Trees(bias, [], {})
    score = np.full(len(x), bias)
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-score))
        tree = _grow(x, good - weight * chance, weight * chance * (1 - chance), 2)
        model.trees.append(tree)
        score = score + _value(tree, x)
    return model


def calibrate(model: Trees, x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> None:
    """Per kind the least score from which on the checked spans are right often enough."""
    score = model.scores(x)
    for kind in np.unique(x[:, 0]):
        mine = np.flatnonzero(x[:, 0] == kind)
        mine = mine[np.argsort(-score[mine])]
        right, every = np.cumsum(good[mine]), np.cumsum(good[mine] + bad[mine])
        last = np.append(score[mine][1:] != score[mine][:-1], True)
        fits = np.flatnonzero(last & (right >= PRECISION * every) & (every >= LEAST_ROWS))
        if len(fits):
            model.thresholds[int(kind)] = float(score[mine[fits[-1]]]) - 1e-9


def fit(found: DataFrame) -> Trees:
    """found: ``found`` as ``detected`` gives it, and ``fold``, 0 for documents to calibrate on."""
    each = found.select("fold", F.explode("found.candidates").alias("c"))
    rows = (
        each.where("c.right is not null")
        .select("fold", "c.right", *[F.col("c")[f].alias(f) for f in FEATURES])
        .groupBy("fold", *FEATURES)
        .agg(F.sum("right").alias("good"), F.count("*").alias("n"))
        .collect()
    )
    rows.sort()
    x = np.array([[r[f] for f in FEATURES] for r in rows], int).reshape(len(rows), len(FEATURES))
    good = np.array([r.good for r in rows], float)
    bad = np.array([r.n for r in rows], float) - good
    checked = np.array([r.fold == 0 for r in rows], bool)
    model = boost(x[~checked], good[~checked], bad[~checked])
    calibrate(model, x[checked], good[checked], bad[checked])
    return model


def all_spans(found: Column, model: Trees) -> tuple[Column, Column]:
    """Base spans and all spans, packed and in order."""
    base = F.concat(*[found["base"][k] for k in KINDS])
    if not model.thresholds:
        return base, base
    chosen = F.filter(found["candidates"], model.accepted)
    added = F.transform(chosen, lambda c: c["span"])
    return base, F.array_sort(F.array_union(base, added))


def written(span_list: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))

    def one(span: Column) -> Column:
        kind, start, end = unpacked(span)
        return F.concat_ws(":", F.get(names, kind), start.cast("string"), end.cast("string"))

    return F.array_join(F.transform(span_list, one), ",")


def _folded(documents: DataFrame, *columns) -> DataFrame:
    fold = F.pmod(F.xxhash64("text"), F.lit(5)).alias("fold")
    return documents.select(*columns, fold, detected(F.col("text")).alias("found"))


def op6_pii(spark, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = materialize(_folded(documents, F.col("doc_id")))
    base, every = all_spans(F.col("found"), fit(found))
    counts = [F.size(F.col("found.base")[k]).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(every).alias("spans"))


def redacted(documents: DataFrame) -> DataFrame:
    """Documents with every span replaced by its kind in brackets; n_chars follows the text.

    Spans that overlap or touch are replaced as one, by the kind of the first.
    """
    model = fit(materialize(_folded(documents)))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("text")

    def in_order(found: Column) -> Column:
        def turned(span: Column) -> Column:
            kind, start, end = unpacked(span)
            return F.struct(start.alias("start"), end.alias("end"), kind.alias("kind"))

        return F.array_sort(F.transform(all_spans(found, model)[1], turned))

    def replaced(ordered: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

        def step(a: Column, s: Column) -> Column:
            gap = F.substring(text, a["at"] + 1, s["start"] - a["at"])
            fresh = F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(gap, F.get(names, s["kind"]))).alias("out"))
            longer = F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))
            return F.when((s["start"] > a["at"]) | (F.size(a["out"]) == 0), fresh).otherwise(longer)

        def closed(a: Column) -> Column:
            return F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text)))

        return F.when(F.size(ordered) > 0, F.aggregate(ordered, start, step, closed)).otherwise(text)

    new = bound(bound(detected(text), in_order), replaced)
    out = documents.withColumn("text", new)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in documents.columns else out

"""Licence scan by a positional index of rare words, in DataFrame functions alone.

Templates are short licence notices. The document frequency of their words is counted over
all documents, and the rarest words of each template, with their positions, are its index.
Where a file has such a word, the template would start at a known word of the file; there the
other index words are looked up by their relative positions, and the template counts if they
carry enough of its weight (inverse document frequency) and if the words of its mandatory
phrase stand where they must. The places of a few phrases, which label by themselves, are
found exactly beside that.

Null and empty texts have no words and no labels. Rows stay one by one; other columns are not
read. No row leaves its partition but for the counts of the templates' words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesengine.llm.common import ascii_lower, table

# Phrases that label by themselves, and notices with their mandatory phrases.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "affero general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "attribution sharealike"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "held liable for any damages"),
)
INDEXED = 4  # rare words of a template
ENOUGH = 0.75  # share of their weight that must stand in place

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    index: tuple[tuple[str, int, float], ...]  # word, position, weight
    required: tuple[tuple[str, int], ...]  # word, position


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _SEPARATORS), "")


def _distinct_words() -> list[str]:
    return sorted({w for _, notice, _ in NOTICES for w in notice.split()})


def build_index(words: DataFrame) -> list[Template]:
    """Templates with their rarest words. words: an array column ``words`` of every document."""
    listed = F.array(*map(F.lit, _distinct_words()))
    counted = words.select(F.explode(F.array_intersect("words", listed)).alias("word"))
    seen = {r.word: r["count"] for r in counted.groupBy("word").count().collect()}
    total = words.count()
    templates = []
    for label, notice, phrase in NOTICES:
        parts, required = notice.split(), phrase.split()
        at = next(i for i in range(len(parts)) if parts[i : i + len(required)] == required)
        weight = {w: math.log((total + 1) / (seen.get(w, 0) + 0.5)) for w in parts}
        rare = sorted({w: i for i, w in reversed(list(enumerate(parts)))}.items(), key=lambda x: (-weight[x[0]], x[1]))
        index = tuple((w, i, max(weight[w], 1e-3)) for w, i in rare[:INDEXED])
        templates.append(Template(label, index, tuple((w, at + k) for k, w in enumerate(required))))
    return templates


def _word_at(start: Column, position: int) -> Column:
    return F.get(F.col("words"), start + position)


def phrase_places(phrase: str) -> Column:
    """The word positions where a phrase stands."""
    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size("words") - len(parts))

    def stands(i: Column) -> Column:
        found = _word_at(i, 0) == parts[0]
        for k in range(1, len(parts)):
            found = found & (_word_at(i, k) == parts[k])
        return found

    none = F.array().cast("array<int>")
    possible = F.size("words") >= len(parts)
    for part in parts:
        possible = possible & F.array_contains("words", part)
    return F.when(possible, F.filter(starts, stands)).otherwise(none)


def template_score(template: Template) -> Column:
    """The best share of the weight at any place where the mandatory phrase stands, or 0."""
    whole = sum(w for _, _, w in template.index)
    places = {w: i for w, i, _ in template.index}
    position = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    listed = F.array(*map(F.lit, places))
    mine = F.filter(F.col("hits"), lambda h: F.array_contains(listed, h["word"]))
    starts = F.array_distinct(F.transform(mine, lambda h: h["at"] - F.element_at(position, h["word"])))

    def score(start: Column) -> Column:
        share = F.lit(0.0)
        for word, at, weight in template.index:
            share = share + F.when((start + at >= 0) & (_word_at(start, at) == word), weight / whole).otherwise(0.0)
        stands = start + template.required[0][1] >= 0
        for word, at in template.required:
            stands = stands & (_word_at(start, at) == word)
        return F.when(stands & (share >= ENOUGH - 1e-9), F.least(share, F.lit(1.0))).otherwise(0.0)

    return F.coalesce(F.array_max(F.transform(starts, score)), F.lit(0.0))


def scanned(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, places per phrase and template scores of every document."""
    words = documents.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    templates = build_index(words)
    rare = F.array(*map(F.lit, sorted({w for t in templates for w, _, _ in t.index})))
    numbered = F.transform("words", lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    hits = F.when(F.arrays_overlap("words", rare), F.filter(numbered, lambda h: F.array_contains(rare, h["word"])))
    nothing = F.array().cast("array<struct<at:int,word:string>>")
    found = words.select(
        "doc_id",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.coalesce(hits, nothing).alias("hits"),
        *[phrase_places(p).alias(f"phrase_{k}") for k, p in enumerate(PHRASES)],
    )
    scores = F.array(*[
        F.struct(F.lit(t.label).alias("label"), template_score(t).alias("score")) for t in templates
    ])
    empty = F.array().cast("array<struct<label:string,score:double>>")
    scored = F.when(F.size("hits") > 0, F.filter(scores, lambda s: s["score"] > 0)).otherwise(empty)
    places = F.struct(*[F.col(f"phrase_{k}") for k in range(len(PHRASES))])
    return found.select("doc_id", "n_words", places.alias("places"), scored.alias("templates"))


def op9_licenses(spark, folder: str) -> DataFrame:
    found = scanned(table(spark, folder, "documents"))
    columns = [F.col(f"places.phrase_{k}") for k in range(len(PHRASES))]
    starts = F.flatten(F.array(*columns))
    base = F.array_distinct(F.array_compact(F.array(*[
        F.when(F.size(c) > 0, label) for c, label in zip(columns, PHRASES.values(), strict=True)
    ])))
    every = F.array_union(base, F.col("templates.label"))
    best = F.greatest(
        F.coalesce(F.array_max("templates.score"), F.lit(0.0)), F.when(F.size(starts) > 0, 1.0).otherwise(0.0)
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        best.alias("score"),
    )

"""URL filter: rules first, then naive Bayes on words that are cut out of host names.

Host names write words without a space. A unigram model counted over the words in the visible
text of all pages gives each letter run of a host its most probable words (Viterbi). In it
each listed word, of an unwanted topic or an ordinary one that holds such a word, has a fixed
share besides its count, words of one or two letters pay for their length, and a word that no
page has is the less probable the longer it is.

An address is labelled unwanted if one of its words is a listed topic, or if one of its pages
is dense with them. A multinomial naive Bayes model learns words from the addresses of four
fifths of the hosts, each class smoothed by the words of both; the other hosts are held out
and judged by it all the same. A listed topic has fixed odds at least, learned or not; a word
that the model has not met has none.

A null url and one without :// have an empty host and path, no words and are allowed; so is
an address with a score of 0. Of equally probable cuts the one with the longest last word is
taken. A letter run of over 63 characters, longer than a host label can be, is cut into runs of
63 first; a longer word of a page can be no part of one and is not counted. Equal addresses get
equal verdicts; rows stay one by one. Only page_id, url and html are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesengine.llm.common import ascii_lower, table
from salesengine.llm.html_text import visible_text
from salesengine.session import materialize

# Words of unwanted topics that label addresses for the training.
TOPICS = (
    "ads adserver adult bet bets betting casino click clickbait crack escort gambling hack jackpot "
    "keygen loan lottery malware payday phishing pills poker popup porn promo roulette sex slots spam "
    "spyware torrent track tracker tracking viagra virus warez xxx"
).split()
# Ordinary words that hold a listed one.
ORDINARY = (
    "adulthood alphabet arcades backtrack barricades beads beheads better between blades broads brigades "
    "clickable clicked cracked cracker crackers cracking crossroads decades diabetes downloads dreads elizabeth essex "
    "facades fads firecracker goads grades hacked hackney heads invades lads leads loads loaned loans loaner middlesex "
    "nomads nutcracker pads parades payload pervades promote promoted promoter promotes promoting promotion promotions "
    "reloads roads seconds sexes sextant sexton shades slotted soundtrack spades spills spreads squads sussex threads tibet "
    "tibetan toads trackside trades treads unisex uploads wessex backtracking crackdown hackathon"
).split()
LONGEST = 63  # of a label, and so of a word in it
LISTED_SHARE = 1e-4  # the share of all words that each listed word has besides its own count
UNKNOWN, UNKNOWN_LETTER = 1e-4, 0.8  # of a word that no page has; powers of ten less for a letter
SHORT = {1: 1e-4, 2: 1e-2}  # what a word of so many letters pays
#: A page is dense if it has so many listed words, and they are such a share of all.
DENSE_WORDS, DENSE_SHARE = 5, 0.05
FOLDS = 5  # of the hosts; those of fold 0 are held out
SMOOTHED = 50.0  # words of both classes that each class has besides its own
LISTED_ODDS = math.log(1000)  # the least log odds of a listed topic
LEAST_SHARE = 0.01  # of unwanted addresses among all

Rule = tuple[str, str, str]  # verdict, host, path
RULES: tuple[Rule, ...] = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _ADDRESS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none fits."""
    name = verdict = F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def best_words(label: str, known: dict[tuple[int, int], float], total: float) -> list[str]:
    """The most probable words of a letter run; known: counts by (start, length)."""
    n = len(label)
    best = [0.0] + [-math.inf] * n
    back = [0] * (n + 1)
    for end in range(1, n + 1):
        for start in range(max(0, end - LONGEST), end):
            size = end - start
            count = known.get((start, size))
            if count:
                chance = math.log(count / total) + math.log(SHORT.get(size, 1.0))
            else:
                chance = math.log(UNKNOWN) - UNKNOWN_LETTER * size * math.log(10)
            chance = round(chance, 9)  # the same for the same share, whatever the total
            if best[start] + chance > best[end]:
                best[end], back[end] = best[start] + chance, start
    words = []
    while n:
        words.append(label[back[n] : n])
        n = back[n]
    return words[::-1]


def _segment(total: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_pylist()
            words = []
            for label, known in zip(labels, batch.column("known").to_pylist(), strict=True):
                counts = {(k["start"], k["size"]): k["n"] for k in known}
                words.append(best_words(label, counts, total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(labels, pa.string()), pa.array(words, pa.list_(pa.string()))], names=["label", "words"]
            )

    return run


def _counted(column: str, text_of):
    """Per row: its url, the distinct words of its text with their counts, all words and listed ones."""
    topics = set(TOPICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts, totals, listed = [], [], [], []
            for value in batch.column(column):
                found = Counter(w.lower() for w in re.findall("[A-Za-z]+", text_of(value.as_py()) or ""))
                totals.append(found.total())
                listed.append(sum(n for w, n in found.items() if w in topics))
                kept = {w: n for w, n in found.items() if len(w) <= LONGEST}
                words.append(list(kept))
                counts.append(list(kept.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("url"), pa.array(words, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64())),
                    pa.array(totals, pa.int64()), pa.array(listed, pa.int64()),
                ],
                names=["url", "words", "counts", "total", "listed"],
            )

    return run


_COUNTED = "url string, words array<string>, counts array<long>, total long, listed long"


def words_of_pages(pages: DataFrame) -> DataFrame:
    """The words in the visible text of each page (url, html)."""
    source = pages.select(F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(_counted("html", visible_text), _COUNTED)


def words_of_texts(texts: DataFrame) -> DataFrame:
    """The words of each text (text, and url where there is one)."""
    url = F.col("url") if "url" in texts.columns else F.lit(None)
    return texts.select(url.cast("string").alias("url"), "text").mapInArrow(_counted("text", str), _COUNTED)


def unigrams(texts: DataFrame) -> DataFrame:
    """(word, n) over the ASCII letter runs of all rows, and the listed words.

    texts: text, or what ``words_of_pages`` gives. n is a double: a listed word's is its own
    count and its share of the count of all words.
    """
    source = texts if "words" in texts.columns else words_of_texts(texts.where("text is not null"))
    each = source.select(F.explode(F.arrays_zip("words", "counts")).alias("w")).select("w.words", "w.counts")
    counted = each.groupBy(F.col("words").alias("word")).agg(F.sum("counts").cast("double").alias("n"))
    counted = materialize(counted)
    share = LISTED_SHARE * (counted.agg(F.sum("n")).first()[0] or 1)
    listed = texts.sparkSession.createDataFrame([(t, share) for t in sorted({*TOPICS, *ORDINARY})], "word string, n double")
    return counted.unionByName(listed).groupBy("word").agg(F.sum("n").alias("n"))


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, words) for distinct letter runs of at most 63 letters, by Viterbi over the unigram counts."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    starts = labels.selectExpr("label", "explode(sequence(1, length(label))) AS start")
    parts = starts.selectExpr("label", "start - 1 AS start", "explode(sequence(1, length(label) - start + 1)) AS size")
    parts = parts.withColumn("word", F.expr("substring(label, start + 1, size)"))
    known = parts.join(counts, "word").groupBy("label").agg(
        F.collect_list(F.struct("start", "size", "n")).alias("known")  # at most 63 a character
    )
    every = labels.join(known, "label", "left").select(
        "label", F.coalesce("known", F.array().cast("array<struct<start:int,size:int,n:double>>")).alias("known")
    )
    return every.mapInArrow(_segment(total), "label string, words array<string>")


def word_odds(tokens: DataFrame) -> tuple[DataFrame, float]:
    """(token, odds), the log odds of an unwanted address by word, and those before any word.

    tokens: tokens and bad (0 or 1) of the addresses to learn from.
    """
    each = tokens.select("bad", F.explode("tokens").alias("token"))
    counts = each.groupBy("token").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good"))
    topics = tokens.sparkSession.createDataFrame([(t,) for t in TOPICS], "token string")
    counts = materialize(counts.join(F.broadcast(topics.withColumn("topic", F.lit(True))), "token", "left"))
    sums = counts.agg(F.sum("bad"), F.sum("good")).first()
    bad_words, good_words = (x or 0 for x in sums)
    seen = tokens.agg(F.sum("bad"), F.count("*")).first()
    share = min(1 - LEAST_SHARE, max(LEAST_SHARE, (seen[0] or 0) / max(1, seen[1])))
    shared = SMOOTHED * (F.col("bad") + F.col("good")) / max(1, bad_words + good_words)
    odds = F.log((F.col("bad") + shared) / (bad_words + SMOOTHED)) - F.log((F.col("good") + shared) / (good_words + SMOOTHED))
    learned = counts.select("token", F.when(F.col("topic"), F.greatest(odds, F.lit(LISTED_ODDS))).otherwise(odds).alias("odds"))
    unmet = topics.join(counts, "token", "left_anti").select("token", F.lit(LISTED_ODDS).alias("odds"))
    return learned.unionByName(unmet), math.log(share / (1 - share))


def judged(pages: DataFrame, texts: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score, unwanted and held_out.

    pages: page_id, url. texts: text, and url where there is one, or what ``words_of_pages``
    gives; the unigrams and the dense pages come from it. score holds the log odds of an
    unwanted address, unwanted its label; rows with held_out are of hosts not learned from.
    """
    located = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    counted = materialize(texts if "words" in texts.columns else words_of_texts(texts.where("text is not null")))
    crowded = (F.col("listed") >= DENSE_WORDS) & (F.col("listed") >= DENSE_SHARE * F.col("total"))
    dense = counted.where(crowded & F.col("url").isNotNull()).select(
        host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.lit(True).alias("dense")
    ).distinct()
    addresses = materialize(located.select("host", "path").distinct())
    runs = addresses.select("host").distinct().select("host", F.posexplode(F.split("host", "[^a-z]+")).alias("at", "run"))
    cut = F.expr(f"regexp_extract_all(run, '[a-z]{{1,{LONGEST}}}', 0)")
    labels = materialize(runs.where("run <> ''").select("host", "at", F.posexplode(cut).alias("then", "label")))
    words = segmented(labels.select("label").distinct(), materialize(unigrams(counted)))
    hosts = labels.join(words, "label").groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("at", "then", "words"))).alias("parts")
    ).select("host", F.flatten("parts.words").alias("host_words"))
    digits = F.regexp_replace(ascii_lower(F.col("path")), "[0-9]+", "0")
    path_words = F.filter(F.split(digits, "[^0-9a-z]+"), lambda w: w != "")
    empty = F.array().cast("array<string>")
    tokens = addresses.join(hosts, "host", "left").join(dense, ["host", "path"], "left").select(
        "host", "path", "dense", F.concat(F.coalesce("host_words", empty), path_words).alias("tokens")
    )
    named = F.arrays_overlap("tokens", F.array(*map(F.lit, TOPICS)))
    unwanted = F.coalesce(named, F.lit(False)) | F.coalesce("dense", F.lit(False))
    held_out = F.crc32(F.encode("host", "utf-8")) % FOLDS == 0
    tokens = materialize(tokens.select("host", "path", "tokens", unwanted.cast("long").alias("bad"), held_out.alias("held_out")))
    weights, prior = word_odds(tokens.where("not held_out"))
    each = tokens.select("host", "path", F.explode("tokens").alias("token"))
    sums = each.join(weights, "token").groupBy("host", "path").agg((F.sum("odds") + prior).alias("score"))
    known = tokens.select("host", "path", (F.col("bad") == 1).alias("unwanted"), "held_out")
    scores = known.join(sums, ["host", "path"], "left").withColumn("score", F.coalesce("score", F.lit(prior)))
    rule, decision = rule_for(F.col("host"), F.col("path"), rules)
    bayes = F.when((F.round("score", 9) > 0) & (F.col("host") != ""), "block").otherwise("allow")
    return located.join(scores, ["host", "path"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decision, bayes).alias("verdict"), "score", "unwanted", "held_out"
    )


def op7_url_filter(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return judged(pages, words_of_pages(pages))

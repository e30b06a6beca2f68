"""Packing of token sequences by shortest-pack-first over the histogram of lengths.

Documents become token ids with an end id, cut at the sequence length. The histogram of the
piece lengths has at most that many bins. From the longest to the shortest, the pieces of a
bin are put, as counts, into the packs that are filled the least and have room, else into new
packs; so a pattern of lengths stands for many sequences. Each piece then gets its rank among
the pieces of its length, and the rank names its pattern, sequence and offset.

Texts are split many at once and each distinct word is looked up once; the ids of all words
are then put in order by Arrow. The token ids of a piece travel with it from the tokenizer to
its place; its checksum is taken of the placed ids. ``sequences`` puts the pieces of each
sequence together.

A tokenizing task numbers its pieces of each length as they come and writes the numbers with
them; a table of how many pieces of a length the tasks before have makes them ranks. So no
piece is shuffled or sorted, and no length, id or text can overload a task. Which pieces
share a sequence follows from the partitions of the input. A null or empty text is the end id alone. Repeated rows and null
ids are packed like any other. Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesengine.llm.common import table
from salesengine.session import materialize

SEQUENCE = 2048
END_ID = 1
#: The most offsets, one per task and length, that are sent to all tasks (some 80 MB); more
#: are joined by a shuffle, with the same result.
BROADCAST_OFFSETS = 2_000_000
#: Words and pieces of words that a worker remembers before it sets them aside. What is met
#: again comes back from there; what is not is forgotten with the next change.
REMEMBERED = 200_000
#: Characters of the longest such word; longer ones seldom come again and would fill the memory.
LONGEST_REMEMBERED = 64
#: Bytes of text, one text at least, that are split into words at once.
AT_ONCE = 8 << 20
#: Bytes of ids, one piece at least, in a batch that goes back to Spark.
BATCH = 64 << 20

# Fixed values of the tokenizer format that the word-wise path knows.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KNOWN_STEPS = ("NFC", "Replace", "Lowercase", "Split", "ByteLevel")
# Letters of Latin-1. They are composed already, also in lower case.
LETTERS = "".join(chr(c) for c in range(256) if chr(c).isalpha())


def _byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, remembered word by word.

    For a tokenizer that normalizes characters one by one and never joins them over white
    space, a text's ids are those of its words. Many texts are split at once, and each
    distinct word is looked up once. Words of letters beyond Latin-1, and all texts of other
    kinds of tokenizers, go through ``Tokenizer.encode`` unchanged.
    """

    def __init__(self, path: str):
        import json

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        steps = [
            *((spec["normalizer"] or {}).get("normalizers") or ()),
            *((spec["pre_tokenizer"] or {}).get("pretokenizers") or ()),
        ]
        kinds = tuple(s["type"] for s in steps)
        self.by_word = kinds == _KNOWN_STEPS and steps[3]["pattern"] == {"Regex": WORD_SPLIT}
        self.marks = [t["content"] for t in spec["added_tokens"]]
        self.by_word = self.by_word and all(m.startswith("<|") for m in self.marks)
        self.split, self.latin = regex.compile(WORD_SPLIT), regex.compile(r"[\x21-\x7e\xa1-\xff]+")
        self.letters = dict(enumerate(_byte_letters()))
        self.tokenize = self.tokenizer.model.tokenize
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.plain = f"^[{LETTERS}]*[.,]*$"
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.StringArray, tail: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, each with ``tail``, and the byte where each ends."""
        if self.by_word:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            words = lists.flatten().dictionary_encode()
            found, stops = self._distinct(words.dictionary), lists.offsets.to_numpy()[1:]
            order = np.insert(words.indices.to_numpy(), stops, len(found))
            found = pa.concat_arrays([found, pa.array([tail], pa.large_binary())]).take(pa.array(order))
            stops = stops + np.arange(1, len(texts) + 1)
        else:
            found = pa.array([self._whole(t) + tail for t in texts.to_pylist()], pa.large_binary())
            stops = np.arange(1, len(texts) + 1)
        _, ends, data = found.buffers()
        ids = np.frombuffer(data or b"", "<u4", np.frombuffer(ends, np.int64)[len(found)] // 4)
        return ids, np.frombuffer(ends, np.int64)[stops]

    def _distinct(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        """Ids of each word: of letters in lower case and of the stops and commas after them, else of the whole."""
        plain = pc.match_substring_regex(words, self.plain)
        stems = pc.if_else(plain, pc.utf8_rtrim(pc.utf8_lower(words), ".,"), words)
        tails = pc.if_else(plain, pc.utf8_ltrim(words, LETTERS), "")
        ids = self._looked_up(stems), self._looked_up(tails)
        return pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))

    def _looked_up(self, words: pa.StringArray) -> pa.LargeBinaryArray:
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        coded, known = words.dictionary_encode(), self.known
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = [known.get(word) for word in words]
        for at, ids in enumerate(found):
            if ids is None:
                found[at] = self._remembered(words[at], self._word)
        return pa.array(found, pa.large_binary()).take(coded.indices)

    def _remembered(self, word: str, encode: Callable[[str], bytes]) -> bytes:
        found = self.known.get(word) or self.older.get(word) or encode(word)
        if len(word) <= LONGEST_REMEMBERED:
            self.known[word] = found
        return found

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of a run of letters, a digit or a run of other characters, in lower case."""
        text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        known = self.bytes_of
        return b"".join([known[t.id] for t in self.tokenize(text)])

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if not word.strip(".,") or word.isalpha() and (word.isascii() or max(word) <= "\xff"):
            return self._piece(word.lower())
        if "<|" in word or not (word.isascii() and word.isprintable() or self.latin.fullmatch(word)):
            return self._whole(word)
        return b"".join([self._remembered(p, self._piece) for p in self.split.findall(word.lower())])


_encoders: dict[str, WordEncoder] = {}


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of ``AT_ONCE`` bytes of text, or one larger text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(), dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + AT_ONCE, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _cut(path: str, end: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:  # one worker serves many tasks
            _encoders[path] = WordEncoder(path)
        encoder, tail = _encoders[path], array("I", [end]).tobytes()
        task, most = TaskContext.get().partitionId(), max(1, BATCH // (4 * longest))
        ranks = np.zeros(longest + 1, np.int64)  # by length, within this task
        for part in (part for batch in batches for part in _parts(batch)):
            ids, ends = encoder.encode_all(pc.fill_null(part.column("text"), ""), tail)
            tokens = np.diff(ends, prepend=0) // 4
            cuts = -(-tokens // longest)
            row = np.repeat(np.arange(len(cuts)), cuts)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * longest
            length = np.minimum(longest, tokens[row] - start)
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order])
            local = np.empty_like(length)
            local[order] = np.arange(len(row)) - first + ranks[length[order]]
            ranks += np.bincount(length, minlength=longest + 1)
            stops = np.cumsum(length)
            columns = {"doc_id": part.column("doc_id").take(pa.array(row)), "start": pa.array(start)}
            columns |= {"length": pa.array(length), "doc_tokens": pa.array(tokens[row]), "local": pa.array(local)}
            columns["task"] = pa.array(np.full(len(row), task, np.int64))
            for at in range(0, len(row), most):
                some = {name: column.slice(at, most) for name, column in columns.items()}
                offsets = np.concatenate([[0], np.cumsum(length[at : at + most])])
                held = ids[stops[at] - length[at] : stops[at] - length[at] + offsets[-1]]
                buffers = [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(held)]
                some["ids"] = pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, buffers)
                yield pa.RecordBatch.from_pydict(some)  # ids as they are: nobody takes them apart

    return run


def spread_patterns(histogram: dict[int, int], longest: int = SEQUENCE) -> list[tuple[int, list[int]]]:
    """(sequences, piece lengths from the first to the last) by shortest-pack-first.

    Where no pack has room, new ones are opened and filled with the same length in turn, as
    placing one piece at a time would.
    """
    open_packs: list[list] = [[] for _ in range(longest + 1)]  # by room: [count, (length, inner)]
    for length in sorted(histogram, reverse=True):
        left, room = histogram[length], longest
        while left:
            while room >= length and not open_packs[room]:
                room -= 1
            if room < length:
                fit = longest // length
                for count, pieces in ((left // fit, fit), (1, left % fit)):
                    if count and pieces:
                        held = None
                        for _ in range(pieces):
                            held = (length, held)
                        open_packs[longest - pieces * length].append((count, held))
                break
            count, held = open_packs[room].pop()
            used = min(left, count)
            if count > used:
                open_packs[room].append((count - used, held))
            open_packs[room - length].append((used, (length, held)))
            left -= used
    patterns = []
    for packs in open_packs:
        for count, held in packs:
            lengths = []
            while held:
                lengths.append(held[0])
                held = held[1]
            patterns.append((count, lengths[::-1]))
    return patterns


def slots(patterns: list[tuple[int, list[int]]], longest: int = SEQUENCE) -> dict[int, np.ndarray]:
    """For each length: first rank, first sequence and offset of every slot of every pattern."""
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rows[length].append((taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return {length: np.array(found, np.int64).T for length, found in rows.items()}


def _listed(ids: pa.BinaryArray) -> tuple[pa.ListArray, pa.Array]:
    """Ids that are written as bytes, as lists of numbers, and the CRC-32 of each row's bytes."""
    _, offsets, data = ids.buffers()
    ends = np.frombuffer(offsets, np.int32)[ids.offset : ids.offset + len(ids) + 1]
    held = memoryview(data) if data is not None else memoryview(b"")
    sums = [zlib.crc32(held[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    values = np.frombuffer(held[ends[0] : ends[-1]], "<u4").astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]) // 4), pa.array(values))
    return lists, pa.array(sums, pa.int64())


def _place(shared, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty_like(length), np.empty_like(length)
            for value in np.unique(length):
                mine = length == value
                first, base, at = by_length[int(value)]
                slot = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine] = base[slot] + rank[mine] - first[slot]
                offset[mine] = at[slot]
            ids, sums = _listed(batch.column("ids"))
            columns = {n: batch.column(n) for n in ("doc_id", "start", "length")}
            columns |= {"ids_crc32": sums, "doc_tokens": batch.column("doc_tokens")}
            columns |= {"ids": ids} if keep_ids else {}
            yield pa.RecordBatch.from_pydict(columns | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return run


def pack(
    documents: DataFrame, tokenizer: str, longest: int = SEQUENCE, end: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset.

    ``tokenizer`` is the path of a tokenizer file that every executor can open. With
    ``keep_ids`` the token ids of the piece are returned too; they are placed in any case.
    """
    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    columns = "doc_id long, start long, length long, doc_tokens long, local long, task long, ids binary"
    pieces = materialize(source.mapInArrow(_cut(tokenizer, end, longest), columns))
    counts = materialize(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    totals = counts.groupBy("length").agg(F.sum("n").alias("n"), F.count("*").alias("cells")).collect()
    if sum(r.cells for r in totals) <= BROADCAST_OFFSETS:
        offsets = F.broadcast(offsets)  # otherwise Spark sorts both sides by length and task
    patterns = spread_patterns({r.length: r.n for r in totals}, longest)
    shared = documents.sparkSession.sparkContext.broadcast(slots(patterns, longest))
    ranked = pieces.join(offsets, ["length", "task"])
    placed = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    placed += "ids array<int>, " if keep_ids else ""
    names = ("doc_id", "start", "length", "doc_tokens", "ids")
    return ranked.select(*names, (F.col("local") + F.col("before")).alias("rank")).mapInArrow(
        _place(shared, keep_ids), placed + "sequence_id long, offset long"
    )


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the token ids of each sequence, from pieces with their ids."""
    parts = pieces.groupBy("sequence_id").agg(  # at most ``longest`` ids
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))


def op8_packing(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=True)

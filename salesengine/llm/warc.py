"""WARC archives compressed with Zstandard, a frame per record and the dictionary in front.

An archive starts with a skippable frame that holds the dictionary, as the WARC-Zstandard
format has it; each record is one frame with its content size. Archives are written by
Spark's text writer, which commits files task by task and writes to any store: a row is an
archive of bounded size and gets a file of its own, and the line separator after it is an
empty skippable frame, so the whole file is valid.

The reader takes whole archives, loads each one's own dictionary, decodes frame by frame and
raises on a wrong version, header, length or digest. Rows of pages become one record each.
A null html is an empty payload, a null url no target. Of records with equal payloads of at
least ``smallest`` bytes the one with the smallest page_id is a response, also when that id
repeats; the others are revisits of it, which store no payload. A record id is made from the
page_id and the payload, so an id that occurs with several payloads has a record of each. A page without an id is a
response unless a page with an id has its payload. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesengine.llm.common import table
from salesengine.session import materialize, scratch_path

# Fixed values of the formats.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FRAME_MAGIC = (0xFD2FB528).to_bytes(4, "little")
EMPTY_FRAME = "P*M\x18\0\0\0\0"  # magic 0x184D2A50 and length 0, all of it ASCII

#: A task starts a new archive once the one before holds so many compressed bytes.
ARCHIVE_BYTES = 32 << 20
#: The dictionary is trained on at most so many pages, those of least hash, and on so many
#: characters of each.
SAMPLE_PAGES, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 8192, 64 << 10
#: Bytes that the reader feeds to a frame at a time; what is left of them is copied.
FEED = 4096
ENOUGH_SAMPLES = 16


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(pages: DataFrame) -> bytes:
    """A dictionary from a bounded sample; no bytes if the sample is too small to train on."""
    place = F.xxhash64("page_id", "url")
    least = pages.select(place.alias("place")).orderBy("place").limit(SAMPLE_PAGES)
    last = least.agg(F.max("place")).first()[0]  # found among the executors; one number comes back
    drawn = pages.where((place <= F.lit(last)) & (F.col("html") != "")).limit(SAMPLE_PAGES)
    rows = drawn.select(F.substring("html", 1, SAMPLE_CHARS)).collect()
    if len(rows) < ENOUGH_SAMPLES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [r[0].encode() for r in rows]).as_bytes()
    except zstandard.ZstdError:
        return b""


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: version, headers, block, and the two line ends after it."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    block = payload if refers_to is None else b""
    if refers_to is not None:
        target = record_id(refers_to, digest)
        digest = sha1_base32(block)
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", target), ("X-Refers-To-Page-ID", str(refers_to))]
    fields += [("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _write(dictionary: bytes, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per archive: the dictionary, then a frame per record."""
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if trained:
            trained.precompute_compress(level=3)  # else every frame would digest it anew
        packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)
        front = DICTIONARY_MAGIC + len(dictionary).to_bytes(4, "little") + dictionary
        archive = bytearray()
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers_to in zip(*columns, strict=True):
                payload = (html.as_py() or "").encode()
                whole = record(page_id.as_py(), url.as_py(), payload, sha1_base32(payload), refers_to.as_py())
                archive += packer.compress(whole) if archive else front + packer.compress(whole)
                if len(archive) >= archive_bytes:
                    yield pa.RecordBatch.from_pydict({"archive": pa.array([bytes(archive)], pa.binary())})
                    archive = bytearray()
        if archive:
            yield pa.RecordBatch.from_pydict({"archive": pa.array([bytes(archive)], pa.binary())})

    return run


def write_archives(
    pages: DataFrame, path: str, smallest: int = 0, archives: int | None = None, archive_bytes: int = ARCHIVE_BYTES
) -> None:
    """Write a record per row of pages (page_id, url, html) into archives under ``path``.

    A task ends an archive at ``archive_bytes`` and starts the next one, so an archive holds
    less than that and one record, however large the partitions are. ``archives`` deals the
    rows to so many tasks, each of which writes at least one archive.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    known = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").withColumn(
        "digest", F.when(F.octet_length("html") >= smallest, F.sha2(payload, 256)) if smallest else F.sha2(payload, 256)
    )
    equal = known.where("digest is not null").groupBy("digest").agg(F.min("page_id").alias("least"), F.count("*").alias("n"))
    refers = known.join(equal.where("n > 1").drop("n"), "digest", "left").withColumn(
        "refers_to", F.when(F.coalesce(F.col("page_id") != F.col("least"), F.col("page_id").isNull()), F.col("least"))
    )
    dealt = refers.select("page_id", "url", "html", "refers_to")
    dealt = dealt.repartition(archives) if archives else dealt
    made = dealt.mapInArrow(_write(train_dictionary(pages), archive_bytes), "archive binary")
    rows = made.select(F.col("archive").cast("string").alias("value"))
    rows.write.option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)


class Malformed(ValueError):
    """An archive that breaks the format."""


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decoded one at a time."""
    view, at, trained = memoryview(archive), 0, None
    if bytes(view[:4]) == DICTIONARY_MAGIC:
        end = 8 + int.from_bytes(view[4:8], "little")
        if end > len(view):
            raise Malformed("the dictionary is cut off")
        data = bytes(view[8:end])
        if data[:4] == FRAME_MAGIC:  # the dictionary itself may be compressed
            data = zstandard.ZstdDecompressor().decompress(data)
        trained, at = zstandard.ZstdCompressionDict(data) if data else None, end
    opened = zstandard.ZstdDecompressor(dict_data=trained)
    while at < len(view):
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + int.from_bytes(view[at + 4 : at + 8], "little")
            continue
        if bytes(view[at : at + 4]) != FRAME_MAGIC:
            raise Malformed(f"no frame at byte {at}")
        unpacker, parts, start = opened.decompressobj(), [], at
        while not unpacker.eof:
            if at >= len(view):
                raise Malformed(f"the frame at byte {start} is cut off")
            try:
                parts.append(unpacker.decompress(view[at : at + FEED]))
            except zstandard.ZstdError as wrong:
                raise Malformed(f"frame at byte {start}: {wrong}") from wrong
            at = min(len(view), at + FEED)
        at -= len(unpacker.unused_data)
        yield b"".join(parts)
    if at > len(view):
        raise Malformed("the last frame is cut off")


def parse(whole: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and block of a record, validated."""
    head, found, rest = whole.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise Malformed("no WARC version or no end of headers")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name or name.strip() != name or name.lower() in fields:
            raise Malformed(f"header {line[:80]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if not fields.get(name):
            raise Malformed(f"no {name}")
    length = fields["content-length"]
    if not length.isascii() or not length.isdigit() or rest[int(length) :] != b"\r\n\r\n":
        raise Malformed(f"the block is not {length} bytes long")
    block = rest[: int(length)]
    digest = f"sha1:{sha1_base32(block)}"
    for name, checked in (("warc-block-digest", True), ("warc-payload-digest", fields["warc-type"] == "response")):
        if checked and name in fields and fields[name] != digest:
            raise Malformed(f"{name} does not fit the block")
    if fields["warc-type"] == "revisit" and "warc-refers-to" not in fields:
        raise Malformed("a revisit that refers to nothing")
    return fields, block


_NUMBERS = ("page_id", "refers_to")
_READ = (
    "page_id long, record_type string, record_id string, refers_to_id string, refers_to long, "
    "url string, payload_digest string, payload_bytes long, payload binary"
)


def _read(keep_payload: bool):
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    names = [f.split(" ")[0] for f in _READ.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for whole in frames(content.as_buffer()):
                    fields, block = parse(whole)
                    kind = fields["warc-type"]
                    ids = [int(v) if (v := fields.get(n)) else None for n in ("x-page-id", "x-refers-to-page-id")]
                    rows.append((
                        ids[0], kind, fields["warc-record-id"], fields.get("warc-refers-to"), ids[1],
                        fields.get("warc-target-uri"), fields.get("warc-payload-digest", "").removeprefix("sha1:"),
                        len(block) if kind == "response" else None, block if keep_payload and kind == "response" else None,
                    ))
                    if len(rows) == 256:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    return run


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """A row per record; a revisit has the digest that it names, and no payload."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(_read(keep_payload), _READ)


def resolved(records: DataFrame) -> DataFrame:
    """Records with the payload length of what a revisit refers to; raises if that is missing."""
    records = materialize(records.drop("payload"))  # read and decoded once
    known = records.where("record_type = 'response'").groupBy(
        F.col("record_id").alias("known_id"), F.col("payload_digest").alias("known_digest")
    ).agg(F.max("payload_bytes").alias("known_bytes"))
    fits = (F.col("refers_to_id") == F.col("known_id")) & (F.col("payload_digest") == F.col("known_digest"))
    joined = records.where("record_type <> 'response'").join(known, fits, "left")
    length = F.when(F.col("known_id").isNotNull(), F.col("known_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("no response for the revisit "), "record_id")).cast("long")
    )
    revisits = joined.withColumn("payload_bytes", length).drop("known_id", "known_bytes", "known_digest")
    return records.where("record_type = 'response'").unionByName(revisits)


def op2_warc(spark, folder: str) -> DataFrame:
    path = scratch_path(spark)
    write_archives(table(spark, folder, "pages"), path)
    return resolved(read_archives(spark, path, keep_payload=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )

"""Where cleaned rows go: fact table, CSV, memory, JDBC, or a callable."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS, SALES_SCHEMA
from ..session import PACKED, join_parts, materialize, scratch, scratch_path, shuffles_dropped
from ..sources.commits import commits, new_data, plain_files, try_commit
from ..sources.csv_lines import (
    POSITION,
    judged_text,
    read_cleaned_text,
    read_lines,
    with_fields,
    with_place,
)
from ..sources.tables import read_sales
from .cleaning import KEY, all_rejects, judged
from .keyed import BROADCAST_KEYS, first_new, first_of_wide, first_per_key, insert_ignore

Sink = Callable[[DataFrame], None]

JDBC_BATCH_ROWS = 100


@dataclass(frozen=True)
class IngestionResult:
    """What one load read, rejected and wrote, and how long it took."""

    rows_read: int
    rows_rejected: int
    rows_written: int
    elapsed_ms: int
    rows_before: int = 0

    @property
    def rows_after(self) -> int:
        return self.rows_before + self.rows_written

    @property
    def rows_clean(self) -> int:
        return self.rows_read - self.rows_rejected

    @property
    def rows_per_second(self) -> float:
        return self.rows_read * 1000 / self.elapsed_ms if self.elapsed_ms > 0 else 0.0


def append_new(
    rows: DataFrame, path: str, position: tuple[str, ...] = (), stored_rows: int | None = None
) -> int:
    """Insert-ignore into the fact table at ``path``; returns rows added.

    The rows are stored once, unless ``stored_rows`` says that they are, and how many. They are
    compared by ``position``, without it by all columns, and with the keys of
    all commits, written, and committed under the next number. A load of many rows does both
    in one shuffle; one of few leaves the stored table where it lies. If another writer has taken
    it, its new rows alone are compared again, so one key never gets two rows. A load that
    is repeated finds its keys and adds nothing.
    """
    spark = rows.sparkSession
    counted = Observation()
    with scratch(spark), shuffles_dropped(spark):
        staged, size = rows, stored_rows
        if size is None:
            staged = materialize(rows.observe(counted, F.count("*").alias("rows")), **PACKED)
            size = counted.get["rows"]
        listed = commits(spark, path)
        before = None if listed else plain_files(spark, path)
        if before:
            try_commit(spark, path, 1, before, rows=None)  # a table from before the log
            listed = commits(spark, path)
        placed = with_place(staged).drop(*position) if position else staged
        place = ("_place",) if position else ()
        if listed and size > BROADCAST_KEYS:
            fresh = first_new(placed, read_sales(spark, path, listed), position=place)
        else:
            fresh = first_per_key(placed, KEY, place) if position else first_of_wide(staged)
            if listed:
                stored = read_sales(spark, path, listed)
                fresh = insert_ignore(fresh, stored, new_rows=size, unique=True)
        fresh = fresh.select(*RAW_COLUMNS)
        while True:
            added, data = Observation(), new_data(path)
            fresh.observe(added, F.count("*").alias("rows")).write.parquet(data)
            new = added.get["rows"]
            number = listed[-1].number + 1 if listed else 1
            if (listed and not new) or try_commit(spark, path, number, data, rows=new):
                return new
            others = commits(spark, path, after=number - 1)
            listed += others
            written = spark.read.schema(SALES_SCHEMA).parquet(data)
            fresh = insert_ignore(written, read_sales(spark, path, others), new_rows=size, unique=True)


def write_csv(rows: DataFrame, folder: str, merge: bool = False, **options: str) -> str:
    """Header, empty text for NULL, quotes only where needed; returns the path.

    Files are as many as the partitions, unless the writer's ``options`` say otherwise. ``merge`` makes one file, named after its row count:
    the parts are written in parallel without headers, and joined in the order of the
    partitions on the file system, behind the header.
    """
    if not merge:
        _csv_writer(rows).options(**options).csv(folder)
        return folder
    spark = rows.sparkSession
    counted = Observation()
    with scratch(spark):
        parts = scratch_path(spark)
        observed = rows.observe(counted, F.count("*").alias("rows"))
        _csv_writer(observed).option("header", False).csv(parts)
        path = f"{folder.rstrip('/')}/final_output_{counted.get['rows']}_rows.csv"
        join_parts(spark, parts, path, (",".join(rows.columns) + "\n").encode())
    return path


def _csv_writer(rows: DataFrame) -> DataFrameWriter:
    writer = rows.write.mode("overwrite").option("header", True).option("escape", '"')
    return writer.option("nullValue", "").option("emptyValue", "")


def keep_in_memory(rows: DataFrame, view: str = "sales_store") -> DataFrame:
    """Cache and register as a view; nothing is copied to the driver."""
    cached = rows.cache()
    cached.createOrReplaceTempView(view)
    return cached


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "batchsize": str(JDBC_BATCH_ROWS)} | extra


def write_jdbc(
    rows: DataFrame, url: str, table: str, position: tuple[str, ...] = (), **extra: str
) -> None:
    """Insert-ignore into a database table, in batches; the driver jar is the user's.

    The stored keys are read over as many connections as the options
    ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` ask for.
    """
    options = jdbc_options(url, table, **extra)
    stored = rows.sparkSession.read.format("jdbc").options(**options).load()
    fresh = insert_ignore(rows, stored, position=position).select(*RAW_COLUMNS)
    fresh.write.format("jdbc").options(**options).mode("append").save()


def write_sales(
    rows: DataFrame, sink: str | Sink, target: str = "", merge: bool = False, **options: str
) -> DataFrame | int | str | None:
    """Send rows to ``table``, ``csv``, ``memory``, ``jdbc``, or a callable of your own.

    Where rows have the columns of ``POSITION``, the first row of a key wins by them.
    """
    position = tuple(c for c in POSITION if c in rows.columns)
    plain = rows.drop(*position)
    if callable(sink):
        return sink(plain)
    if sink == "table":
        return append_new(rows, target, position)
    if sink == "csv":
        return write_csv(plain, target, merge)
    if sink == "memory":
        return keep_in_memory(plain, target or "sales_store")
    if sink == "jdbc":
        return write_jdbc(rows, target, position=position, **options)
    raise ValueError(f"unknown sink {sink}")


def ingest(
    spark: SparkSession,
    source: str | list[str],
    table: str,
    rejects: str,
    skip_header: bool = True,
    truncate: bool = False,
) -> IngestionResult:
    """Load raw CSV into the fact table, first row of each new key in file order.

    Lines that cannot be a row and rows that do not fit the table go to ``rejects``;
    with ``truncate`` only a key that is too long turns a row away. The source is read,
    split and cleaned once; rows and rejects are taken from what that has stored.
    """
    started = time.monotonic()
    known = commits(spark, table) or plain_files(spark, table)
    before = read_sales(spark, table).count() if known else 0
    with scratch(spark):
        lines, read, turned_away = store_judged(read_lines(spark, source, skip_header), truncate)
        written = append_new(fact_rows(lines), table, POSITION, read - turned_away)
        if turned_away:
            rejects_of(lines).write.mode("append").parquet(rejects)
    elapsed = int((time.monotonic() - started) * 1000)
    return IngestionResult(read, turned_away, written, elapsed, before)


def store_judged(lines: DataFrame, truncate: bool = False) -> tuple[DataFrame, int, int]:
    """Raw lines judged and stored in one pass; how many there are, and how many are rejects."""
    seen = Observation()
    counts = F.count("*").alias("rows"), F.count("reason").alias("rejects")
    known = judged(with_fields(lines), POSITION, truncate).observe(seen, *counts)
    with shuffles_dropped(lines.sparkSession):
        stored = materialize(known, **PACKED)
    return stored, seen.get["rows"], seen.get["rejects"]


def fact_rows(lines: DataFrame) -> DataFrame:
    """The rows among judged lines, with their places."""
    return lines.where("reason is null").select(*RAW_COLUMNS, *POSITION)


def rejects_of(lines: DataFrame) -> DataFrame:
    return lines.where("reason is not null").select("line", "reason", "file")


def bulk_load(spark: SparkSession, source: str | list[str], table: str, rejects: str) -> IngestionResult:
    """Load cleaned CSV with headers into the fact table; what does not fit goes to ``rejects``.

    A number or date that cannot be read, and a text that is too long, turns its row away; an
    empty value is NULL, except in the key. The source is read and parsed once; rows and
    rejects are taken from what that has stored.
    """
    started = time.monotonic()
    known = commits(spark, table) or plain_files(spark, table)
    before = read_sales(spark, table).count() if known else 0
    seen = Observation()
    counts = F.count("*").alias("rows"), F.count("reason").alias("rejects")
    with scratch(spark):
        lines = materialize(judged_text(read_cleaned_text(spark, source)).observe(seen, *counts))
        read, turned_away = seen.get["rows"], seen.get["rejects"]
        bad = lines.where("reason is not null")
        bad.select("line", "reason", F.lit(None).cast("string").alias("file")).write.mode("append").parquet(rejects)
        rows = lines.where("reason is null").select(*RAW_COLUMNS)
        written = append_new(rows, table, stored_rows=read - turned_away)
    elapsed = int((time.monotonic() - started) * 1000)
    return IngestionResult(read, turned_away, written, elapsed, before)


def write_rejects(fields: DataFrame, path: str, truncate: bool = False) -> int:
    """Append the rejects of split lines to ``path``; returns how many."""
    count = Observation()
    bad = all_rejects(fields, truncate).observe(count, F.count("*").alias("rows"))
    bad.write.mode("append").parquet(path)
    return count.get["rows"]

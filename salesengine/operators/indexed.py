"""A fact table that is clustered by its key, so that loads shuffle nothing that is stored.

Rows lie in buckets by the hash of ``order_id`` and sorted by it within a file, and each row
group has a Bloom filter of its keys. A load shuffles its own keys to the buckets and meets
the stored keys where they lie; of a load of few keys the scan also gets the keys themselves,
so that row groups without any of them are not read. The number of buckets is fixed when the
table is made: choose it so that the keys of a bucket, a few tens of bytes a row, suit a task.

The table is known to the session's catalog under a name; the files are the table's state, and
``open_indexed`` makes it known again in another session. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS, SALES_SCHEMA
from ..session import PACKED, materialize, scratch, shuffles_dropped
from ..sources.csv_lines import with_place
from .keyed import first_by_place, first_of_wide

KEY = "order_id"
#: Loads of up to so many keys hand them to the scan, if the session pushes lists that long.
LISTED_KEYS = 1000
#: New keys of a bucket, in rows, that a task holds in a hash table; more are sorted, on disk where need be.
HASHED_KEYS = 1_000_000
#: Rows that a task sorts for a bucket; of a larger load each bucket gets several files.
FILE_ROWS = 4_000_000


def open_indexed(
    spark: SparkSession, name: str, path: str, buckets: int, keys_per_group: int = 1_000_000
) -> None:
    """Make the table at ``path`` known as ``name``; it is empty if nothing is there yet.

    ``keys_per_group`` is the number of keys that the Bloom filter of a row group is made for.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SALES_SCHEMA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"OPTIONS ('parquet.bloom.filter.enabled#{KEY}' 'true', "
        f"'parquet.bloom.filter.expected.ndv#{KEY}' '{keys_per_group}') "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )


def buckets_of(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def known_keys(
    new: DataFrame, name: str, listed: list[str] | None = None, hashed: bool = True
) -> DataFrame:
    """The keys of ``new`` that the table has; only ``new`` is shuffled.

    The stored keys stream past a hash table of the bucket's new keys, which must fit a task.
    If they may not, ``hashed`` is to be false: both sides are sorted then. ``listed`` are the
    new keys once more, for the scan.
    """
    stored = new.sparkSession.table(name).select(KEY)
    if listed is not None:
        stored = stored.where(F.col(KEY).isin(listed))
    return stored.join(new.select(KEY).hint("shuffle_hash" if hashed else "merge"), KEY, "left_semi")


def append_indexed(rows: DataFrame, name: str, position: tuple[str, ...] = ()) -> int:
    """Insert-ignore into the table ``name``, one file per bucket and ``FILE_ROWS``; returns rows added.

    Rows without a key are one row of the key NULL, which is added once.
    """
    spark = rows.sparkSession
    counted, added = Observation(), Observation()
    with scratch(spark), shuffles_dropped(spark):
        staged = materialize(rows.observe(counted, F.count("*").alias("rows")), **PACKED)
        size, buckets = counted.get["rows"], buckets_of(spark, name)
        first = first_by_place(with_place(staged)) if position else first_of_wide(staged)
        first = first.select(*RAW_COLUMNS)
        listed = None
        if size <= LISTED_KEYS:
            listed = [r[KEY] for r in staged.select(KEY).distinct().collect() if r[KEY] is not None]
        hashed = size <= HASHED_KEYS * buckets
        known = materialize(known_keys(staged, name, listed, hashed).distinct(), **PACKED)
        fresh = first.join(known, KEY, "left_anti")
        if not spark.table(name).where(F.col(KEY).isNull()).isEmpty():
            fresh = fresh.where(F.col(KEY).isNotNull())
        # A multiple of the buckets, so that the rows of a part have the same bucket. The writer sorts.
        parts = buckets * max(1, -(-size // (FILE_ROWS * buckets)))
        # Counted behind the shuffle: AQE drops what stands before one that has no rows.
        fresh = fresh.repartition(parts, KEY).observe(added, F.count("*").alias("rows"))
        fresh.write.insertInto(name)
    return added.get["rows"]

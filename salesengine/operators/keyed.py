"""One row per key: dedupe and insert-ignore."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

BROADCAST_KEYS = 1_000_000


def _same(keys: Sequence[str]) -> Column:
    """Keys equal to those of ``_numbered`` keys, nulls too."""
    tests = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return reduce(Column.__and__, tests)


def _contested(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Keys with several rows, as ``_key0`` …, from counts in a narrow hash aggregate.

    They are stored, so that their size decides how they are joined.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("_rows"), *more).where("_rows > 1")
    named = {k: f"_key{i}" for i, k in enumerate(keys)}
    return materialize(counted.drop("_rows").withColumnsRenamed(named))


def first_per_key(
    rows: DataFrame, key: str | Sequence[str], position: Sequence[str] = ()
) -> DataFrame:
    """The row of each key that comes first by ``position``, then by all columns.

    For narrow rows. The least row is an aggregate, so each task sends on at most one row
    per key: a key that holds a third of all rows costs one row per task, where a
    window would sort it whole in one. Rows equal in every column are one row,
    so the result never depends on the order of arrival.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lead = [c for c in position if c not in keys]
    rest = [c for c in rows.columns if c not in keys and c not in lead]
    if not lead + rest:
        return rows.distinct()
    first = rows.groupBy(*keys).agg(F.min(F.struct(*lead, *rest)).alias("_first"))
    kept = {c: F.col(c) for c in keys} | {c: F.col("_first")[c] for c in lead + rest}
    return first.select(*[kept[c].alias(c) for c in rows.columns])


def first_of_wide(rows: DataFrame, key: str = "order_id") -> DataFrame:
    """``first_per_key`` for wide rows that are stored: only rows that share a key are compared.

    The shared keys come from a count in a hash aggregate of the keys alone. All other rows
    pass without a shuffle or a sort. Where too many keys are shared to be sent to the rows,
    one aggregate of all rows shuffles less than two joins.
    """
    contested = _contested(rows, [key])
    if contested.count() > BROADCAST_KEYS:
        return first_per_key(rows, key)
    alone = rows.join(contested, _same([key]), "left_anti")
    shared = rows.join(contested, _same([key]), "left_semi")
    return alone.unionByName(first_per_key(shared, key))


def first_by_place(rows: DataFrame, key: str = "order_id", place: str = "_place") -> DataFrame:
    """The row of each key with the least ``place``, a number that no two rows share.

    ``rows`` are read three times, so they should be stored. Count and least place per key
    come from a hash aggregate of two narrow columns; then only the places of the losing
    rows are gathered, and an anti join drops these. Nothing sorts or shuffles wide rows
    unless the losers are too many to be sent to them, and then by place, which is never hot.
    """
    contested = _contested(rows, [key], F.min(place).alias("_least"))
    behind = _same([key]) & (F.col(place) > F.col("_least"))
    losers = materialize(rows.select(key, place).join(contested, behind).select(place))
    return rows.join(losers, place, "left_anti").select(*rows.columns)


def first_new(
    new: DataFrame, stored: DataFrame, key: str = "order_id", position: Sequence[str] = ()
) -> DataFrame:
    """``insert_ignore`` for loads of many rows: one aggregate finds the first row of each key
    and whether it is known.

    A stored key comes in as a row before all others of its key, so the rows of the load are
    shuffled once, and of the stored table nothing but the keys. Stored rows without a key
    match no others, as in a join.
    """
    known = stored.select(key).where(F.col(key).isNotNull())
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema.fields if f.name != key]
    known = known.select(key, *nothing).withColumn("_new", F.lit(False))
    both = new.select(key, *[c for c in new.columns if c != key]).withColumn("_new", F.lit(True))
    first = first_per_key(both.unionByName(known), key, ("_new", *position))
    return first.where("_new").select(*new.columns)


def insert_ignore(
    new: DataFrame,
    stored: DataFrame,
    key: str = "order_id",
    position: Sequence[str] = (),
    new_rows: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Rows to append to ``stored``: the first of each new key, known keys left alone.

    ``stored`` is read for its key column only. Loads that know their row count
    pass it: up to ``BROADCAST_KEYS`` the new keys go to the stored table, which
    is then filtered where it lies instead of being shuffled. Larger loads, or
    loads of unknown size, shuffle both sides on the key. ``unique`` says that
    the new rows have one row per key already.
    """
    first = new if unique else first_per_key(new, key, position)
    known = stored.select(key)
    if new_rows is not None and new_rows <= BROADCAST_KEYS:
        known = known.join(F.broadcast(new.select(key)), key, "left_semi")
    return first.join(known, key, "left_anti").select(*new.columns)

"""Global ranks without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# monotonically_increasing_id keeps the partition above bit 33, the row below it.
_ROW_BITS = 33


def global_rank(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Row number over all rows in ``order``, which must be total.

    A range sort spreads the rows; the rank is the place inside a partition
    plus the rows of the partitions before it. Only those counts, one per
    partition, pass through one task. The sorted rows are stored first, so
    both readers see the same partitions.
    """
    place = F.monotonically_increasing_id()
    ordered = materialize(rows.orderBy(*order).withColumn("_place", place))
    part = F.shiftright("_place", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    in_part = F.col("_place") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return (
        ordered.withColumn("_part", part)
        # One row per sort partition, so its size is set by the configuration.
        .join(F.broadcast(offsets), "_part")
        .select(*rows.columns, (F.col("_before") + in_part + 1).alias(name))
    )


def top_k(rows: DataFrame, order: Sequence[Column], k: int, name: str | None = None) -> DataFrame:
    """The first ``k`` rows, each task keeping its own best; ``name`` numbers them."""
    best = rows.orderBy(*order).limit(k)
    if name is None:
        return best
    return best.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def rank_of(candidates: DataFrame, rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Where a few candidate rows stand among all ``rows`` by ``order``.

    ``order`` names columns both frames have, a leading '-' meaning descending.
    The candidates must be few, as from ``top_k``, and be among ``rows``: they
    travel as one array, and each task counts the rows up to each of them.
    """

    def standing(of: str) -> Column:
        terms = []
        for column in order:
            value = F.col(f"{of}{column.lstrip('-')}")
            terms.append(-value if column.startswith("-") else value)
        return F.struct(*[t.alias(f"t{i}") for i, t in enumerate(terms)])

    listed = candidates.agg(F.collect_list(F.struct(*candidates.columns)))
    names = [c.lstrip("-") for c in order]
    ahead = rows.select(*names, F.explode(listed.scalar()).alias("_c")).where(
        standing("") <= standing("_c.")
    )
    return ahead.groupBy("_c").agg(F.count("*").alias(name)).select("_c.*", name)

"""Refresh by change: sums that add up, kept per version, and fed by new rows alone.

Every summary comes from a small state: totals per month, per product, per region and
product, per category and discount, the five strongest rows of each kind, and the power
sums of the prices. All of it can be merged, so a refresh reads the rows of the commits
since the last one and the state, and no other row of the fact. State and summaries are
published together; the version notes up to which commit of the fact it has gone. A load
or batch that is replayed adds no commit, so nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch
from ..sources.commits import commits, last_commit
from ..sources.tables import read_sales
from . import discounts, monthly, products, regions
from .anomalies import merged_strongest, records_of, strongest
from .refresh import publish, to_table


@dataclass(frozen=True)
class Totals:
    """Keys, sums, and how they come from fact rows."""

    keys: tuple[str, ...]
    sums: tuple[str, ...]
    of: Callable[[DataFrame], DataFrame]

    def merged(self, parts: DataFrame) -> DataFrame:
        """One row per key. Sums get the widest type, so that any number of parts fits."""
        added = []
        for name in self.sums:
            kind = parts.schema[name].dataType
            wide = "bigint" if kind.typeName() in ("long", "integer") else f"decimal(38,{kind.scale})"
            added.append(F.sum(name).cast(wide).alias(name))
        return parts.groupBy(*self.keys).agg(*added)


STATE = {
    "months": Totals(("year", "month"), monthly.SUMS, monthly.month_totals),
    "products": Totals(("product_name", "category"), products.SUMS, products.product_totals),
    "regions": Totals(
        ("region", "product_name", "category"), regions.SUMS, regions.region_products
    ),
    "categories": Totals(
        ("category", "discount_percent"), discounts.SUMS, discounts.category_values
    ),
}
ROWS, MOMENTS = "strongest", "moments"
#: Folder names of the state beside the tables.
PREFIX = "state_"


def state_of(sales: DataFrame) -> dict[str, DataFrame]:
    """The state of stored fact rows, which have no order twice."""
    found = {name: totals.merged(totals.of(sales)) for name, totals in STATE.items()}
    found[ROWS], found[MOMENTS] = strongest(sales)
    return found


def merged(one: dict[str, DataFrame], other: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The state of the rows of both."""
    both = {name: part.unionByName(other[name]) for name, part in one.items()}
    found = {name: totals.merged(both[name]) for name, totals in STATE.items()}
    found[ROWS], found[MOMENTS] = merged_strongest(both[ROWS], both[MOMENTS])
    return found


def summaries_of(state: dict[str, DataFrame], variant: str = "service") -> dict[str, DataFrame]:
    """The five summaries, as ``refresh_all`` makes them from the whole fact."""
    if variant not in ("service", "script"):
        raise ValueError(f"unknown variant {variant}")
    script = variant == "script"
    stats = products.stats_of(state["products"])
    return {
        "monthly_sales_summary": monthly.month_summary(state["months"]),
        "top_products": products.two_step_of(stats) if script else products.top_products_of(stats),
        "region_wise_performance": regions.region_summary(state["regions"]),
        "category_discount_map": discounts.category_summary(state["categories"], median=script),
        "anomaly_records": records_of(state[ROWS], state[MOMENTS]),
    }


def refresh_changes(
    spark: SparkSession, sales_path: str, folder: str, variant: str = "service"
) -> int:
    """Bring the summaries in ``folder`` up to the last commit of the fact; returns its number.

    Only commits that the newest version has not gone through are read. Without new commits
    nothing is written. A fact without a log is to be refreshed by ``refresh_all``.
    """
    newest = last_commit(spark, folder)
    upto = newest.note.get("upto", 0) if newest else 0
    fresh = commits(spark, sales_path, after=upto)
    if not fresh:
        return upto
    with scratch(spark):
        state = state_of(read_sales(spark, sales_path, fresh))
        if upto:
            names = {name: f"{newest.data}/{PREFIX}{name}" for name in state}
            state = merged({name: spark.read.parquet(path) for name, path in names.items()}, state)
        state = {name: materialize(part) for name, part in state.items()}
        tables = {PREFIX + name: lambda part=part: part for name, part in state.items()}
        tables |= {
            name: lambda name=name, summary=summary: to_table(summary, name)
            for name, summary in summaries_of(state, variant).items()
        }
        publish(spark, folder, tables, upto=fresh[-1].number, variant=variant)
    return fresh[-1].number

"""Best products by revenue and by units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import mean, ratio
from ..operators.ranking import global_rank, rank_of, top_k
from ..session import materialize

COLUMNS = ("product_name", "category", "quantity", "unit_price", "discount_percent", "revenue")
OUTPUT = (
    "product_name",
    "category",
    "total_revenue",
    "total_units_sold",
    "avg_unit_price",
    "avg_discount",
    "revenue_rank",
    "units_rank",
)
LISTED = 10
UNRANKED = 999

# Equal totals are ordered by name, so ranks never depend on the run.
_BY_UNITS = ("-total_units_sold", "product_name", "category")


def by_revenue() -> list[Column]:
    return [F.desc("total_revenue"), F.asc("product_name"), F.asc("category")]


def by_units() -> list[Column]:
    return [F.desc("total_units_sold"), F.asc("product_name"), F.asc("category")]


def product_stats(sales: DataFrame) -> DataFrame:
    """One row per product and category over rows that sold something."""
    return (
        sales.where(F.col("quantity") > 0)
        .groupBy("product_name", "category")
        .agg(
            F.round(F.sum("revenue"), 2).alias("total_revenue"),
            F.sum("quantity").alias("total_units_sold"),
            mean(F.col("unit_price"), 2, "decimal(12,2)").alias("avg_unit_price"),
            mean(F.col("discount_percent"), 4).alias("avg_discount"),
        )
    )


SUMS = ("_revenue", "_units", "_price", "_prices", "_discount", "_discounts")


def product_totals(sales: DataFrame) -> DataFrame:
    """Totals per product over rows that sold something; they add up over parts of the fact."""
    return (
        sales.where(F.col("quantity") > 0)
        .groupBy("product_name", "category")
        .agg(
            F.sum("revenue").alias("_revenue"),
            F.sum("quantity").alias("_units"),
            F.sum(F.col("unit_price").cast("decimal(12,2)")).alias("_price"),
            F.count("unit_price").alias("_prices"),
            F.sum(F.col("discount_percent").cast("decimal(10,2)")).alias("_discount"),
            F.count("discount_percent").alias("_discounts"),
        )
    )


def stats_of(totals: DataFrame) -> DataFrame:
    """``product_stats`` from ``product_totals`` with one row per product."""
    return totals.select(
        "product_name",
        "category",
        F.round("_revenue", 2).alias("total_revenue"),
        F.col("_units").alias("total_units_sold"),
        ratio(F.col("_price"), F.col("_prices"), 2).alias("avg_unit_price"),
        ratio(F.col("_discount"), F.col("_discounts"), 4).alias("avg_discount"),
    )


def _nameless() -> Column:
    return F.col("product_name").isNull() | F.col("category").isNull()


def top_products(sales: DataFrame) -> DataFrame:
    """Top ten by revenue with their units rank, and nameless units leaders.

    A product without name or category finds no partner in the other ranking:
    it is listed with 999 there, and once more when it is in the units top ten.
    """
    return top_products_of(product_stats(sales))


def top_products_of(stats: DataFrame) -> DataFrame:
    """``top_products`` from ``product_stats``."""
    stats = materialize(stats)
    leaders = top_k(stats, by_revenue(), LISTED, "revenue_rank")
    first = rank_of(leaders, stats, _BY_UNITS, "_standing").withColumn(
        "units_rank", F.when(_nameless(), UNRANKED).otherwise(F.col("_standing"))
    )
    second = (
        top_k(stats, by_units(), LISTED, "units_rank")
        .where(_nameless())
        .withColumn("revenue_rank", F.lit(UNRANKED).cast("bigint"))
    )
    return first.select(*OUTPUT).unionByName(second.select(*OUTPUT)).distinct()


def top_products_two_step(sales: DataFrame) -> DataFrame:
    """Top ten by revenue, then the top ten by units among the products not yet listed."""
    return two_step_of(product_stats(sales))


def two_step_of(stats: DataFrame) -> DataFrame:
    """``top_products_two_step`` from ``product_stats``."""
    stats = materialize(stats)
    no_rank = F.lit(None).cast("bigint")
    first = top_k(stats, by_revenue(), LISTED, "revenue_rank").withColumn("units_rank", no_rank)
    others = stats.join(
        F.broadcast(first.select("product_name", "category")),
        ["product_name", "category"],
        "left_anti",
    )
    second = top_k(others, by_units(), LISTED, "units_rank").withColumn("revenue_rank", no_rank)
    return first.select(*OUTPUT).unionByName(second.select(*OUTPUT))


def ranked_both_ways(sales: DataFrame) -> DataFrame:
    """Every product with its revenue rank and, by a left join on both names, its units rank."""
    stats = materialize(product_stats(sales))
    revenue = global_rank(stats, by_revenue(), "revenue_rank")
    units = global_rank(
        stats.select("product_name", "category", "total_units_sold"), by_units(), "units_rank"
    ).drop("total_units_sold")
    joined = revenue.join(units, ["product_name", "category"], "left")
    return joined.withColumn(
        "units_rank", F.coalesce("units_rank", F.lit(UNRANKED).cast("bigint"))
    ).select(*OUTPUT)

"""Performance of regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import exact_ratio, ratio
from ..session import materialize

COLUMNS = (
    "product_name",
    "category",
    "quantity",
    "discount_percent",
    "region",
    "revenue",
)


def _named() -> Column:
    return F.col("region").isNotNull() & (F.col("region") != "")


def region_top_product(sales: DataFrame) -> DataFrame:
    """The product and category that earn most in each region.

    The window runs over the product totals, and Spark keeps each task's best
    row per region before it shuffles them.
    """
    totals = (
        sales.where(_named())
        .groupBy("region", "product_name", "category")
        .agg(F.sum("revenue").alias("product_revenue"))
    )
    best = Window.partitionBy("region").orderBy(
        F.desc("product_revenue"), F.asc("product_name"), F.asc("category")
    )
    return (
        totals.withColumn("_place", F.row_number().over(best))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


SUMS = ("_revenue", "_quantity", "_discount", "_discounts", "_orders", "_market")


def region_products(sales: DataFrame) -> DataFrame:
    """Totals per region, product and category; they add up over parts of the fact."""
    earned = F.col("revenue")
    return sales.groupBy("region", "product_name", "category").agg(
        F.sum("revenue").alias("_revenue"),
        F.sum("quantity").alias("_quantity"),
        F.sum(F.col("discount_percent").cast("decimal(10,2)")).alias("_discount"),
        F.count("discount_percent").alias("_discounts"),
        F.count("*").alias("_orders"),
        F.sum(F.when(earned > 0, earned)).alias("_market"),
    )


def region_summary(products: DataFrame, distinct: DataFrame | None = None) -> DataFrame:
    """The summary from ``region_products``; ``distinct`` has other order counts per region.

    The best product is an aggregate. Only the region rows are kept for the market total,
    which counts every row with positive revenue, also of rows without a region.
    """
    best_first = F.struct(
        F.col("_revenue").isNull(), -F.col("_revenue"), F.col("product_name"), F.col("category")
    )
    regions = products.groupBy("region").agg(
        *[F.sum(c).alias(c) for c in SUMS],
        F.min_by(F.struct("product_name", "category"), best_first).alias("_best"),
    )
    regions = materialize(
        regions.withColumnsRenamed({"_quantity": "total_quantity", "_orders": "total_orders"})
    )
    market = regions.agg(F.sum("_market"))
    regions = regions.where(_named())
    if distinct is not None:
        regions = regions.drop("total_orders").join(distinct, "region", "left")
    revenue = F.round("_revenue", 2)
    percents = (revenue.cast("decimal(34,2)") * 10_000).cast("decimal(38,0)")
    cents = (market.scalar().cast("decimal(34,2)") * 100).cast("decimal(38,0)")
    return regions.select(
        "region",
        revenue.alias("total_revenue"),
        "total_orders",
        "total_quantity",
        ratio(F.col("_revenue"), F.col("total_orders"), 2).alias("avg_order_value"),
        ratio(F.col("_discount"), F.col("_discounts"), 4).alias("avg_discount"),
        F.col("_best.product_name").alias("top_product"),
        F.col("_best.category").alias("top_category"),
        exact_ratio(percents, cents, 2).cast("double").alias("market_share_pct"),
    )


def region_performance(sales: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Totals, averages, best product and share of the market per region.

    The fact is read once. Keys that may repeat cost one more pass for the distinct count.
    """
    distinct = None
    if not unique_orders:
        distinct = sales.where(_named()).groupBy("region").agg(
            F.countDistinct("order_id").alias("total_orders")
        )
    return region_summary(region_products(sales), distinct)

"""What a dashboard reads from the summary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label

LISTED = 10
CHARTED = 5


def monthly_listing(monthly: DataFrame) -> DataFrame:
    label = month_label(F.col("year"), F.col("month"))
    return monthly.select(
        "year",
        "month",
        "total_revenue",
        "total_quantity",
        "avg_discount",
        "order_count",
        label.alias("month_label"),
    ).orderBy("year", "month")


def top_products_listing(products: DataFrame) -> DataFrame:
    """Products with a revenue rank; those listed for their units alone drop out."""
    return (
        products.where(F.col("revenue_rank") <= LISTED)
        .select(
            "product_name",
            "category",
            "total_revenue",
            "total_units_sold",
            "avg_unit_price",
            "revenue_rank",
        )
        .orderBy("revenue_rank")
    )


def top_products_chart(products: DataFrame) -> DataFrame:
    return top_products_listing(products).limit(CHARTED)


def region_listing(regions: DataFrame) -> DataFrame:
    return regions.select(
        "region", "total_revenue", "total_orders", "market_share_pct", "top_product"
    ).orderBy(F.desc("total_revenue"), "region")


def category_listing(categories: DataFrame) -> DataFrame:
    return (
        categories.select(
            "category", "avg_discount", "total_revenue", "total_orders", "discount_impact"
        )
        .orderBy(F.desc("avg_discount"), "category")
        .limit(LISTED)
    )


def product_listing(products: DataFrame) -> DataFrame:
    """All stored products, those without a rank last."""
    return products.select(
        "product_name",
        "category",
        "total_revenue",
        "total_units_sold",
        "revenue_rank",
        "units_rank",
    ).orderBy(
        F.coalesce("revenue_rank", F.lit(999)), F.coalesce("units_rank", F.lit(999))
    )


def summary(monthly: DataFrame, regions: DataFrame, products: DataFrame) -> DataFrame:
    """One row; orders without a date are in no month and so not in its totals."""
    return monthly.agg(
        F.sum("total_revenue").alias("total_revenue"), F.sum("order_count").alias("total_orders")
    ).select(
        "total_revenue",
        "total_orders",
        regions.agg(F.countDistinct("region")).scalar().alias("total_regions"),
        products.where(F.col("revenue_rank") <= LISTED)
        .agg(F.count("*"))
        .scalar()
        .alias("top_products_count"),
    )

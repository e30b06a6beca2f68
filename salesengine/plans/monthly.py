"""Sales per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import mean, ratio

COLUMNS = ("quantity", "discount_percent", "sale_date", "revenue")


def orders_of(unique_orders: bool) -> Column:
    """Distinct orders; a plain count where the writer already keeps keys unique."""
    return F.count("*") if unique_orders else F.countDistinct("order_id")


def monthly_sales(sales: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Per year and month; rows without a date are left out."""
    return (
        sales.where(F.col("sale_date").isNotNull())
        .groupBy(F.year("sale_date").alias("year"), F.month("sale_date").alias("month"))
        .agg(
            F.round(F.sum("revenue"), 2).alias("total_revenue"),
            F.sum("quantity").alias("total_quantity"),
            mean(F.col("discount_percent"), 4).alias("avg_discount"),
            orders_of(unique_orders).alias("order_count"),
        )
    )


SUMS = ("_revenue", "_quantity", "_discount", "_discounts", "_orders")


def month_totals(sales: DataFrame) -> DataFrame:
    """Totals per month of orders that do not repeat; they add up over parts of the fact."""
    return (
        sales.where(F.col("sale_date").isNotNull())
        .groupBy(F.year("sale_date").alias("year"), F.month("sale_date").alias("month"))
        .agg(
            F.sum("revenue").alias("_revenue"),
            F.sum("quantity").alias("_quantity"),
            F.sum(F.col("discount_percent").cast("decimal(10,2)")).alias("_discount"),
            F.count("discount_percent").alias("_discounts"),
            F.count("*").alias("_orders"),
        )
    )


def month_summary(totals: DataFrame) -> DataFrame:
    """The summary from ``month_totals`` with one row per month."""
    return totals.select(
        "year",
        "month",
        F.round("_revenue", 2).alias("total_revenue"),
        F.col("_quantity").alias("total_quantity"),
        ratio(F.col("_discount"), F.col("_discounts"), 4).alias("avg_discount"),
        F.col("_orders").alias("order_count"),
    )

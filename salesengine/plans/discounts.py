"""Discounts per category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import mean, ratio

COLUMNS = ("category", "quantity", "unit_price", "discount_percent", "revenue")


def _discounted() -> Column:
    return (
        F.col("category").isNotNull()
        & (F.col("category") != "")
        & (F.col("discount_percent") >= 0)
    )


def _sold() -> Column:
    return (F.col("unit_price") > 0) & (F.col("quantity") > 0)


def _given_away() -> Column:
    return F.col("unit_price") * F.col("quantity") - F.col("revenue")


def category_discount(sales: DataFrame) -> DataFrame:
    """The summary the dashboard reads; its median column repeats the mean."""
    percent = F.col("discount_percent")
    average = mean(percent, 4)
    return (
        sales.where(_discounted() & _sold())
        .groupBy("category")
        .agg(
            average.alias("avg_discount"),
            F.round(F.min(percent), 4).alias("min_discount"),
            F.round(F.max(percent), 4).alias("max_discount"),
            average.alias("median_discount"),
            F.count("*").alias("total_orders"),
            F.round(F.sum("revenue"), 2).alias("total_revenue"),
            F.round(F.sum(_given_away()), 2).alias("discount_impact"),
        )
    )


def _with_ranges(values: DataFrame) -> DataFrame:
    """Per category, the places its discounts take in sorted order.

    ``values`` has one row per category and discount with its row count
    ``_rows``. The fact type allows 10^5 discounts, so a category that holds a
    third of the fact is still a small window.
    """
    whole = Window.partitionBy("category")
    upto = whole.orderBy("discount_percent").rowsBetween(Window.unboundedPreceding, 0)
    return values.withColumn("_last", F.sum("_rows").over(upto)).withColumn(
        "_total", F.sum("_rows").over(whole)
    )


def _median() -> Column:
    """Mean of the two middle values, which are the same row for odd counts."""
    first = F.col("_last") - F.col("_rows") + 1

    def at(place: Column) -> Column:
        return F.max(F.when(place.between(first, F.col("_last")), F.col("discount_percent")))

    low, high = F.floor((F.col("_total") + 1) / 2), F.ceil((F.col("_total") + 1) / 2)
    return (at(low) + at(high)) / 2


def category_median(sales: DataFrame) -> DataFrame:
    """Exact median discount per category from counts per value."""
    counts = (
        sales.where(_discounted()).groupBy("category", "discount_percent").agg(
            F.count("*").alias("_rows")
        )
    )
    return (
        _with_ranges(counts)
        .groupBy("category")
        .agg(F.round(_median(), 4).alias("median_discount"), F.sum("_rows").alias("row_count"))
    )


SUMS = ("_rows", "_sold", "_revenue", "_given_away")


def category_values(sales: DataFrame) -> DataFrame:
    """Totals per category and discount; they add up over parts of the fact."""
    sold = _sold()
    return (
        sales.where(_discounted())
        .groupBy("category", "discount_percent")
        .agg(
            F.count("*").alias("_rows"),
            F.count_if(sold).alias("_sold"),
            F.sum(F.when(sold, F.col("revenue"))).alias("_revenue"),
            F.sum(F.when(sold, _given_away())).alias("_given_away"),
        )
    )


def category_summary(values: DataFrame, median: bool) -> DataFrame:
    """The summary from ``category_values``; without ``median`` the mean is repeated."""
    percent = F.col("discount_percent")
    seen = F.when(F.col("_sold") > 0, percent)
    average = ratio(F.sum(percent * F.col("_sold")), F.sum("_sold"), 4)
    return (
        (_with_ranges(values) if median else values)
        .groupBy("category")
        .agg(
            average.alias("avg_discount"),
            F.round(F.min(seen), 4).alias("min_discount"),
            F.round(F.max(seen), 4).alias("max_discount"),
            (F.round(_median(), 4) if median else average).alias("median_discount"),
            F.sum("_sold").alias("total_orders"),
            F.round(F.sum("_revenue"), 2).alias("total_revenue"),
            F.round(F.sum("_given_away"), 2).alias("discount_impact"),
        )
        .where(F.col("total_orders") > 0)
    )


def category_discount_median(sales: DataFrame) -> DataFrame:
    """The same summary with the true median, whose rows need not have been sold.

    Both populations come from one aggregate per category and discount, so the
    fact is read once and nothing is joined.
    """
    return category_summary(category_values(sales), median=True)

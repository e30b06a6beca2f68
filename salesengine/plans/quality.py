"""Checks over the summary tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import exact_ratio, mean


def check_months(monthly: DataFrame) -> DataFrame:
    return monthly.agg(
        F.count("*").alias("total_months"),
        F.min("year").alias("earliest_year"),
        F.max("year").alias("latest_year"),
        F.sum("total_revenue").alias("grand_total_revenue"),
        F.sum("order_count").alias("total_orders"),
    )


def check_products(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count("*").alias("total_products"),
        F.count_if(F.col("revenue_rank") <= 10).alias("top_revenue_products"),
        F.count_if(F.col("units_rank") <= 10).alias("top_units_products"),
        F.max("total_revenue").alias("highest_revenue"),
        F.max("total_units_sold").alias("highest_units"),
    )


def check_regions(regions: DataFrame) -> DataFrame:
    return regions.agg(
        F.count("*").alias("total_regions"),
        F.sum("total_revenue").alias("grand_total_revenue"),
        F.sum("total_orders").alias("grand_total_orders"),
        mean(F.col("market_share_pct"), 2).alias("avg_market_share"),
        F.max("market_share_pct").alias("highest_market_share"),
    )


def check_share_total(regions: DataFrame) -> DataFrame:
    """Near 100, not always 100: shares are of the positive revenue only."""
    return regions.agg(F.round(F.sum("market_share_pct"), 2).alias("total_market_share_pct"))


def check_categories(categories: DataFrame) -> DataFrame:
    return categories.agg(
        F.count("*").alias("total_categories"),
        mean(F.col("avg_discount"), 4).alias("overall_avg_discount"),
        F.round(F.sum("total_revenue"), 2).alias("grand_total_revenue"),
        F.round(F.sum("discount_impact"), 2).alias("total_discount_impact"),
    )


def check_anomalies(anomalies: DataFrame) -> DataFrame:
    score = F.col("anomaly_score")
    return anomalies.groupBy("anomaly_type").agg(
        F.count("*").alias("anomaly_count"),
        F.round(F.max(score), 2).alias("max_score"),
        F.round(F.min(score), 2).alias("min_score"),
        exact_ratio(F.sum(score) * 10_000, F.count(score) * 10_000, 2).alias("avg_score"),
    )


def anomaly_listing(anomalies: DataFrame) -> DataFrame:
    return anomalies.select(
        "order_id",
        "product_name",
        "anomaly_type",
        F.round("anomaly_score", 2).alias("anomaly_score"),
        "percentile",
    ).orderBy("anomaly_type", F.desc("anomaly_score"), "order_id")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, one row each."""
    counts = [
        table.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)

"""Rebuilding the five summary tables from the fact table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import SUMMARY_SCHEMAS
from ..session import scratch
from ..sources.commits import last_commit, new_data, sweep, try_commit
from ..sources.tables import read_sales, read_summaries
from .anomalies import anomaly_records
from .discounts import category_discount, category_discount_median
from .monthly import monthly_sales
from .products import top_products, top_products_two_step
from .quality import row_counts
from .regions import region_performance

Plan = Callable[[DataFrame], DataFrame]
KEPT_VERSIONS = 3


def summary_plans(variant: str = "service", unique_orders: bool = True) -> dict[str, Plan]:
    """The plan of each table, in refresh order.

    ``service`` lists the top ten by revenue and repeats the mean as median;
    ``script`` lists by revenue and then by units, with the true median.
    ``unique_orders`` holds for a fact table written by insert-ignore.
    """
    if variant not in ("service", "script"):
        raise ValueError(f"unknown variant {variant}")
    script = variant == "script"
    return {
        "monthly_sales_summary": lambda sales: monthly_sales(sales, unique_orders),
        "top_products": top_products_two_step if script else top_products,
        "region_wise_performance": lambda sales: region_performance(sales, unique_orders),
        "category_discount_map": category_discount_median if script else category_discount,
        "anomaly_records": lambda sales: anomaly_records(sales, stored=True),
    }


def to_table(summary: DataFrame, name: str) -> DataFrame:
    """Stored types, and when the row was written."""
    stamps = ["created_at"] if name == "anomaly_records" else ["created_at", "updated_at"]
    return summary.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUMMARY_SCHEMAS[name].fields],
        *[F.current_timestamp().alias(stamp) for stamp in stamps],
    )


def publish(spark: SparkSession, folder: str, tables: dict[str, Callable[[], DataFrame]], **note) -> DataFrame:
    """Write the tables into a new version and make it the one that is read; returns row counts.

    Readers see the version before until all tables are there, whatever fails. If another
    refresh has been published meanwhile, this one comes after it. The versions before the
    last ``KEPT_VERSIONS`` are deleted.
    """
    data = new_data(folder)
    for name, table in tables.items():
        with scratch(spark):
            table().write.parquet(f"{data}/{name}")
    newest = last_commit(spark, folder)
    number = newest.number + 1 if newest else 1
    while not try_commit(spark, folder, number, data, **note):
        number += 1
    sweep(spark, folder, KEPT_VERSIONS)
    return row_counts(read_summaries(spark, folder))


def refresh_all(
    spark: SparkSession,
    sales_path: str,
    folder: str,
    variant: str = "service",
    unique_orders: bool = True,
) -> DataFrame:
    """Rebuild the five tables from one state of the fact; returns their row counts.

    A failing table stops the refresh and leaves all five as they were. Every plan scans the
    columns it needs from the stored fact. Summaries come out as few files as their size
    asks for, since AQE merges small partitions.
    """
    sales = read_sales(spark, sales_path)
    tables = {
        name: lambda name=name, plan=plan: to_table(plan(sales), name)
        for name, plan in summary_plans(variant, unique_orders).items()
    }
    return publish(spark, folder, tables)

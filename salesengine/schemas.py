"""Column order and types of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

# The CSV header, which is also the column order of the fact table.
RAW_COLUMNS = (
    "order_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "discount_percent",
    "region",
    "sale_date",
    "customer_email",
    "revenue",
)

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

# A cleaned row before it is stored: money is still double, as parsed.
CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("discount_percent", T.DoubleType()),
        T.StructField("region", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("revenue", T.DoubleType()),
    ]
)

# The stored fact table, with text lengths in VARCHAR_LENGTHS.
SALES_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("discount_percent", T.DecimalType(5, 2)),
        T.StructField("region", T.StringType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("customer_email", T.StringType()),
        T.StructField("revenue", T.DecimalType(12, 2)),
    ]
)

VARCHAR_LENGTHS = {
    "order_id": 20,
    "product_name": 100,
    "category": 50,
    "region": 20,
    "customer_email": 100,
}

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("file", T.StringType()),
    ]
)

# Sums over a 100 TB fact pass the 13 integer digits of DECIMAL(15,2), so the
# stored sums and scores are wider; values that fit are the same.
MONEY_SUM = T.DecimalType(24, 2)
PERCENT = T.DecimalType(6, 2)

SUMMARY_SCHEMAS = {
    "monthly_sales_summary": T.StructType(
        [
            T.StructField("year", T.IntegerType()),
            T.StructField("month", T.IntegerType()),
            T.StructField("total_revenue", MONEY_SUM),
            T.StructField("total_quantity", T.LongType()),
            T.StructField("avg_discount", PERCENT),
            T.StructField("order_count", T.LongType()),
        ]
    ),
    "top_products": T.StructType(
        [
            T.StructField("product_name", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("total_revenue", MONEY_SUM),
            T.StructField("total_units_sold", T.LongType()),
            T.StructField("avg_unit_price", T.DecimalType(10, 2)),
            T.StructField("avg_discount", PERCENT),
            T.StructField("revenue_rank", T.LongType()),
            T.StructField("units_rank", T.LongType()),
        ]
    ),
    "region_wise_performance": T.StructType(
        [
            T.StructField("region", T.StringType()),
            T.StructField("total_revenue", MONEY_SUM),
            T.StructField("total_orders", T.LongType()),
            T.StructField("total_quantity", T.LongType()),
            T.StructField("avg_order_value", T.DecimalType(12, 2)),
            T.StructField("avg_discount", PERCENT),
            T.StructField("top_product", T.StringType()),
            T.StructField("top_category", T.StringType()),
            T.StructField("market_share_pct", T.DecimalType(7, 2)),
        ]
    ),
    "category_discount_map": T.StructType(
        [
            T.StructField("category", T.StringType()),
            T.StructField("avg_discount", PERCENT),
            T.StructField("min_discount", PERCENT),
            T.StructField("max_discount", PERCENT),
            T.StructField("median_discount", PERCENT),
            T.StructField("total_orders", T.LongType()),
            T.StructField("total_revenue", MONEY_SUM),
            T.StructField("discount_impact", MONEY_SUM),
        ]
    ),
    "anomaly_records": T.StructType(
        [
            T.StructField("order_id", T.StringType()),
            T.StructField("product_name", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("region", T.StringType()),
            T.StructField("quantity", T.IntegerType()),
            T.StructField("unit_price", T.DecimalType(10, 2)),
            T.StructField("discount_percent", T.DecimalType(7, 4)),
            T.StructField("revenue", T.DecimalType(15, 2)),
            T.StructField("sale_date", T.StringType()),
            T.StructField("customer_email", T.StringType()),
            T.StructField("anomaly_type", T.StringType()),
            T.StructField("anomaly_score", T.DecimalType(16, 4)),
            T.StructField("percentile", T.DecimalType(5, 2)),
        ]
    ),
}

ANOMALY_TYPES = (
    "HIGH_REVENUE",
    "HIGH_QUANTITY",
    "HIGH_DISCOUNT",
    "NEGATIVE_VALUES",
    "PRICE_ANOMALY",
)

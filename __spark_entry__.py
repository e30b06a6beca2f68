"""Every query of the engine over the given tables, and its SQL counterpart."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from salesengine.functions.dates import month_label, str_to_date
from salesengine.operators import cleaning
from salesengine.operators import sinks as loads
from salesengine.operators.indexed import append_indexed, open_indexed
from salesengine.operators.keyed import first_new, first_per_key
from salesengine.operators.ranking import global_rank
from salesengine.operators.sinks import append_new, ingest, write_csv
from salesengine.plans import anomalies, dashboard, discounts, monthly, products, quality, regions
from salesengine.plans.refresh import refresh_all, summary_plans, to_table
from salesengine.plans.state import refresh_changes
from salesengine.schemas import RAW_COLUMNS, SALES_SCHEMA, SUMMARY_SCHEMAS
from salesengine.session import (
    PACKED,
    materialize,
    scratch,
    scratch_path,
    shuffles_dropped,
    split_huge_methods,
)
from salesengine.sources.csv_lines import (
    empty_to_null,
    field,
    read_cleaned,
    read_lines,
    with_fields,
)
from salesengine.sources.star import star_lines, star_raw, star_sales
from salesengine.sources.tables import read_sales, read_summaries
from salesengine.streaming.ingest import start_ingest, stream_metrics

try:
    import corpus_pipeline
    from salesengine.llm import queries as llm_queries
except ModuleNotFoundError as missing:  # both may be absent; errors inside them show
    if missing.name not in ("corpus_pipeline", "salesengine.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


def report(df: DataFrame) -> DataFrame:
    """Plain types for comparison: decimals as double, integers as bigint, dates as text."""
    columns = []
    for f in df.schema.fields:
        column, kind = F.col(f.name), f.dataType.typeName()
        if kind == "decimal":
            column = column.cast("double")
        elif kind == "integer":
            column = column.cast("bigint")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def importable(query: Query) -> Query:
    """Let the Python workers of a local session find this folder, wherever it was started."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        here, known = str(Path(__file__).resolve().parent), spark.sparkContext.environment
        paths = known.get("PYTHONPATH", "").split(":")
        if here not in paths:
            known["PYTHONPATH"] = ":".join(filter(None, [here, *paths]))
        return query(spark, folder)

    return run


def compiled(query: Query) -> Query:
    """Run with generated methods that the JIT takes; texts are made and cleaned in long ones."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        split_huge_methods(spark)
        return query(spark, folder)

    return run


def entry(spark: SparkSession) -> DataFrame:
    return queries()["region_performance"](spark, SMOKE_DIR)


# --- cleaning ---------------------------------------------------------------


def cleaned(*columns: str, needs: tuple[str, ...] = ()) -> Query:
    """Cleaned columns of all messy rows, reading only the raw columns they need."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        raw = star_raw(spark, folder, ("order_id", *(needs or columns)))
        missing = [c for c in RAW_COLUMNS if c not in raw.columns]
        padded = raw.withColumns({c: F.lit(None).cast("string") for c in missing})
        return report(cleaning.clean_sales(padded).select("order_id", *columns))

    return run


def staged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines as CSV files, scanned and split."""
    path = scratch_path(spark)
    star_lines(spark, folder).write.text(path)
    return with_fields(read_lines(spark, path, skip_header=False))


def clean_sales(spark: SparkSession, folder: str) -> DataFrame:
    return report(cleaning.split_and_clean(staged_lines(spark, folder)))


def csv_parse(spark: SparkSession, folder: str) -> DataFrame:
    return staged_lines(spark, folder).select(
        F.size("fields").cast("bigint").alias("field_count"),
        *[field(F.col("fields"), i).alias(name) for i, name in enumerate(RAW_COLUMNS)],
    )


def row_width_filter(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.wide_enough(staged_lines(spark, folder)).select(
        field(F.col("fields"), 0).alias("order_id"),
        F.size("fields").cast("bigint").alias("field_count"),
    )


def rejects(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.rejected(staged_lines(spark, folder)).select("line", "reason")


def bulk_load_nullif(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows back to text, with blanks in every column but the key, then loaded."""
    clean = cleaning.clean_sales(star_raw(spark, folder), ("_v",))
    blanks = dict(
        product_name=0, category=1, quantity=2, unit_price=3, discount_percent=4, region=5, revenue=6
    )
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS}
    text |= {c: F.when(F.col("_v") % 9 == k, "").otherwise(text[c]) for c, k in blanks.items()}
    return report(empty_to_null(clean.select(*[text[c].alias(c) for c in RAW_COLUMNS])))


def insert_ignored(spark: SparkSession, folder: str) -> DataFrame:
    """Dated rows are loaded first, then all rows; a key loaded before is left alone."""
    rows = materialize(cleaning.to_stored(cleaning.clean_sales(star_raw(spark, folder))))
    stored = materialize(first_per_key(rows.where(F.col("sale_date").isNotNull()), "order_id"))
    return report(stored.unionByName(first_new(rows, stored)))


def str_to_dates(spark: SparkSession, folder: str) -> DataFrame:
    raw = star_raw(spark, folder, ("order_id", "sale_date"))
    return report(raw.select("order_id", str_to_date(F.col("sale_date")).alias("sale_date")))


# --- loads ------------------------------------------------------------------


#: Files of a task end at so many lines, since a gzipped one is read by one task.
PACKED_CSV = {"compression": "gzip", "maxRecordsPerFile": "1000000"}


def staged(
    lines: DataFrame, path: str, latest: bool, where: str = "true", header: str = "", files: int = 0
) -> None:
    """Lines as CSV files at ``path`` with all lines, those that share an order in one task's files, in text order or against it."""
    key = F.substring_index("value", ",", 1).alias("_key")
    lines = lines.select("value", key).where(where)
    lines = lines.repartition(files, "_key") if files else lines.repartition("_key")
    lines = lines.sortWithinPartitions(F.desc("value") if latest else F.asc("value"))
    writer = {} if files else PACKED_CSV
    with shuffles_dropped(lines.sparkSession):
        if header:  # one column without any quoting, under a name that is the header line
            plain = {"header": True, "sep": "\x01", "quote": "\x02", "escape": "\x02", "emptyValue": ""}
            plain |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            lines.select(F.col("value").alias(header)).write.options(**writer, **plain).csv(path)
        else:
            lines.select("value").write.options(**writer).text(path)
    return path


def made_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All order lines, stored, so that what their joins have shuffled goes before they are staged."""
    with shuffles_dropped(spark):
        return materialize(star_lines(spark, folder), **PACKED)


def ingest_table(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the orders, then all lines again in another order; the first row of a key stays."""
    table, rejects, some, every = (scratch_path(spark) for _ in range(4))
    with scratch(spark):
        lines = made_lines(spark, folder)
        staged(lines, some, False, "length(_key) % 3 = 0")
        staged(lines, every, True)
    for source in (some, every):
        ingest(spark, source, table, rejects, skip_header=False)
    return report(read_sales(spark, table))


def header_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Files that begin with a header each."""
    table, source = scratch_path(spark), scratch_path(spark)
    with scratch(spark):
        staged(made_lines(spark, folder), source, True, header=",".join(RAW_COLUMNS))
    ingest(spark, source, table, scratch_path(spark))
    return report(read_sales(spark, table))


def streamed(spark: SparkSession, folder: str, metrics: str | None = None) -> str:
    """All lines as files that a stream works off in three batches; the table they go to."""
    table = scratch_path(spark)
    files = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))
    source = scratch_path(spark)
    with scratch(spark):
        staged(made_lines(spark, folder), source, True, files=files)
    start_ingest(
        spark, source, table, scratch_path(spark), scratch_path(spark), skip_header=False,
        max_files_per_trigger=-(-files // 3), metrics=metrics,
    ).awaitTermination()
    return table


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    return report(read_sales(spark, streamed(spark, folder)))


def refresh_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """All five summaries after three loads, each brought in from its new rows alone."""
    table, summaries = scratch_path(spark), scratch_path(spark)
    sales = materialize(star_sales(spark, folder))
    for part in ("length(order_id) % 3 = 0", "length(order_id) % 3 < 2", "true"):
        append_new(sales.where(part), table)
        refresh_changes(spark, table, summaries, "script")
    shown = {
        "monthly_sales_summary": ("year, month", "total_revenue", "avg_discount", "order_count"),
        "top_products": ("product_name, category", "total_revenue", "avg_discount", "total_units_sold"),
        "region_wise_performance": ("region, top_product", "total_revenue", "market_share_pct", "total_orders"),
        "category_discount_map": ("category", "discount_impact", "median_discount", "total_orders"),
        "anomaly_records": ("anomaly_type, order_id", "anomaly_score", "percentile", "quantity"),
    }
    parts = [
        read_summaries(spark, summaries)[name].selectExpr(
            f"'{name}' AS summary", f"concat_ws('|', {item}) AS item", f"cast({amount} AS double) AS amount",
            f"cast({rate} AS double) AS rate", f"cast({number} AS bigint) AS number",
        )
        for name, (item, amount, rate, number) in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def awkward_rejects(spark: SparkSession, folder: str) -> tuple[DataFrame, int, int]:
    """Rejects, and rows read and written, where keys are too long and lines are blank."""
    source, table, rejects = (scratch_path(spark) for _ in range(3))
    kind = F.length("value") % 10
    line = F.when(kind == 0, "").when(kind == 1, F.concat(F.lit("x" * 21), "value"))
    star_lines(spark, folder).select(line.otherwise(F.col("value"))).write.text(source)
    result = ingest(spark, source, table, rejects, skip_header=False)
    return spark.read.parquet(rejects), result.rows_read, result.rows_rejected


def strict_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return awkward_rejects(spark, folder)[0].select("line", "reason")


def blank_lines(spark: SparkSession, folder: str) -> DataFrame:
    rejected, read, turned_away = awkward_rejects(spark, folder)
    blank = rejected.where("reason = 'blank line'").agg(F.count("*").alias("blank_lines"))
    return blank.select(
        "blank_lines",
        F.lit(read).cast("bigint").alias("rows_read"),
        F.lit(turned_away).cast("bigint").alias("rows_rejected"),
    )


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = write_csv(star_sales(spark, folder), scratch_path(spark))
    return report(read_cleaned(spark, path))


def csv_merged(spark: SparkSession, folder: str) -> DataFrame:
    """All rows in one file, joined from parts."""
    path = write_csv(star_sales(spark, folder), scratch_path(spark), merge=True)
    return report(read_cleaned(spark, path))


def bulk_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with texts as they came, of which a bulk load turns some away."""
    raw = star_raw(spark, folder).select(*RAW_COLUMNS)
    long = F.when(F.length("customer_email") % 5 == 0, F.repeat(F.col("customer_email"), 9))
    raw = raw.withColumns({"customer_email": F.coalesce(long, "customer_email"), "sale_date": F.lit("")})
    rejects = scratch_path(spark)
    loads.bulk_load(spark, write_csv(raw, scratch_path(spark)), scratch_path(spark), rejects)
    return spark.read.parquet(rejects).select(F.substring_index("line", ",", 1).alias("order_id"), "reason")


def stream_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What a stream says it has read, rejected and written, over all its batches."""
    metrics = scratch_path(spark)
    streamed(spark, folder, metrics=metrics)
    found = stream_metrics(spark, metrics)
    names = ("rows_read", "rows_rejected", "rows_written")
    sums = [sum(getattr(r, n) for r in found) for n in names]
    return spark.range(1).select(*[F.lit(x).cast("bigint").alias(n) for n, x in zip(names, sums, strict=True)])


def bulk_load(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned files into the fact table, dated rows first; what is there already stays out."""
    table = scratch_path(spark)
    with scratch(spark):
        with shuffles_dropped(spark):
            sales = materialize(star_sales(spark, folder), **PACKED)
        for rows in (sales.where("sale_date is not null"), sales):
            with scratch(spark):
                path = write_csv(rows, scratch_path(spark), **PACKED_CSV)
                append_new(read_cleaned(spark, path), table)
    return report(read_sales(spark, table))


def indexed_load(spark: SparkSession, folder: str) -> DataFrame:
    """The same into a clustered table: dated rows, then all, then a few that are known."""
    name = f"indexed_{uuid.uuid4().hex}"
    open_indexed(spark, name, scratch_path(spark), buckets=8)
    with scratch(spark):
        with shuffles_dropped(spark):
            sales = materialize(star_sales(spark, folder), **PACKED)
        for part in ("sale_date is not null", "true", "order_id like '1-%'"):
            append_indexed(sales.where(part), name)
    return report(spark.table(name))


def refreshed(name: str) -> Query:
    """A summary table as the refresh stores it."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        sales, summaries = scratch_path(spark), scratch_path(spark)
        star_sales(spark, folder, SALES_SCHEMA.names).write.parquet(sales)
        refresh_all(spark, sales, summaries, "script")
        return report(read_summaries(spark, summaries)[name])

    return run


# --- summaries --------------------------------------------------------------

Plan = Callable[[DataFrame], DataFrame]


def over_sales(plan: Plan, columns: tuple[str, ...], *then: Plan) -> Query:
    """A plan over the fact rows, which insert-ignore has made unique by order."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        result = plan(star_sales(spark, folder, columns))
        for step in then:
            result = step(result)
        return report(result)

    return run


def monthly_plan(sales: DataFrame) -> DataFrame:
    return monthly.monthly_sales(sales, unique_orders=True)


def region_plan(sales: DataFrame) -> DataFrame:
    return regions.region_performance(sales, unique_orders=True)


def as_stored(name: str) -> Plan:
    """A summary with the types of its stored table."""
    return lambda summary: to_table(summary, name).select(*SUMMARY_SCHEMAS[name].names)


def by_order(sales: DataFrame) -> DataFrame:
    """Order ids without the line number, so that they repeat."""
    return sales.withColumn("order_id", F.split_part(F.col("order_id"), F.lit("-"), F.lit(1)))


def some_nameless(sales: DataFrame) -> DataFrame:
    third = F.length("product_name") % 3 == 0
    return sales.withColumn("category", F.when(~third, F.col("category")))


def month_labels(sales: DataFrame) -> DataFrame:
    dated = sales.where(F.col("sale_date").isNotNull())
    return dated.select(
        month_label(F.year("sale_date"), F.month("sale_date")).alias("month_label")
    ).distinct()


def rank_by_revenue(sales: DataFrame) -> DataFrame:
    stats = products.product_stats(sales).select("product_name", "category", "total_revenue")
    return global_rank(stats, products.by_revenue(), "revenue_rank")


def unclamped(sales: DataFrame) -> DataFrame:
    """Discounts up to 120 percent, as before cleaning."""
    percent = (F.col("quantity") * F.lit(2.4).cast("decimal(2,1)")).cast("decimal(5,2)")
    return sales.withColumn("discount_percent", percent)


def flipped(sales: DataFrame) -> DataFrame:
    """Negative prices and revenues on some of the rows."""
    flip = F.when(F.col("quantity") % 7 == 0, -1).otherwise(1)
    return sales.withColumns(
        {
            "unit_price": (F.col("unit_price") * flip).cast("decimal(10,2)"),
            "revenue": (F.col("revenue") * flip).cast("decimal(12,2)"),
        }
    )


def refresh_report(spark: SparkSession, folder: str) -> DataFrame:
    """All five summaries over one stored fact table, counted."""
    sales = materialize(star_sales(spark, folder))
    tables = {name: plan(sales) for name, plan in summary_plans().items()}
    return report(quality.row_counts(tables))


def dash_summary(spark: SparkSession, folder: str) -> DataFrame:
    needed = dict.fromkeys(monthly.COLUMNS + regions.COLUMNS + products.COLUMNS)
    sales = materialize(star_sales(spark, folder, needed))
    return report(
        dashboard.summary(monthly_plan(sales), region_plan(sales), products.top_products(sales))
    )


def dash_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The summary of the dashboard over written tables."""
    sales, summaries = scratch_path(spark), scratch_path(spark)
    star_sales(spark, folder, SALES_SCHEMA.names).write.parquet(sales)
    refresh_all(spark, sales, summaries)
    tables = read_summaries(spark, summaries)
    names = ("monthly_sales_summary", "region_wise_performance", "top_products")
    return report(dashboard.summary(*[tables[n] for n in names]))


def anomaly_high(plan: Callable[..., DataFrame], column: str) -> Query:
    """The score needs order lines alone, so the tables of texts are joined to five rows."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        scores = star_sales(spark, folder, ("order_id", column))
        return report(plan(star_sales(spark, folder), scores=scores))

    return run


def anomaly_price(spark: SparkSession, folder: str) -> DataFrame:
    """The threshold needs prices alone, so its pass joins nothing."""
    prices = star_sales(spark, folder, ("unit_price",))
    return report(anomalies.price_anomalies(star_sales(spark, folder), prices=prices))


def anomaly_plan(sales: DataFrame) -> DataFrame:
    return anomalies.anomaly_records(materialize(sales), stored=True)


def training_data_queries() -> dict[str, Query]:
    if not llm_queries:
        return {}
    return llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def queries() -> dict[str, Query]:
    own = {name: compiled(query) for name, query in sales_queries().items()}
    return own | {name: importable(query) for name, query in training_data_queries().items()}


def sales_queries() -> dict[str, Query]:
    every = RAW_COLUMNS
    return {
        "csv_parse": csv_parse,
        "row_width_filter": row_width_filter,
        "rejects": rejects,
        "bulk_load_nullif": bulk_load_nullif,
        "insert_ignore": insert_ignored,
        "clean_product": cleaned("product_name"),
        "clean_category": cleaned("category"),
        "clean_quantity": cleaned("quantity"),
        "clean_price": cleaned("unit_price"),
        "clean_discount": cleaned("discount_percent"),
        "clean_region": cleaned("region"),
        "clean_email": cleaned("customer_email"),
        "revenue": cleaned("revenue", needs=("quantity", "unit_price", "discount_percent")),
        "parse_date": cleaned("sale_date"),
        "clean_sales": clean_sales,
        "str_to_date": str_to_dates,
        "month_label": over_sales(month_labels, ("sale_date",)),
        "monthly_sales": over_sales(monthly_plan, monthly.COLUMNS),
        "rank_global": over_sales(rank_by_revenue, products.COLUMNS),
        "join_rank_left": over_sales(products.ranked_both_ways, products.COLUMNS),
        "top_products": over_sales(products.top_products, products.COLUMNS),
        "top_products_two_step": over_sales(products.top_products_two_step, products.COLUMNS),
        "region_top_product": over_sales(regions.region_top_product, regions.COLUMNS),
        "region_performance": over_sales(region_plan, regions.COLUMNS),
        "category_discount": over_sales(discounts.category_discount, discounts.COLUMNS),
        "category_median": over_sales(discounts.category_median, discounts.COLUMNS),
        "category_discount_median": over_sales(
            discounts.category_discount_median, discounts.COLUMNS
        ),
        "price_threshold": over_sales(anomalies.price_threshold, ("unit_price",)),
        "cross_join_scalar": over_sales(anomalies.above_threshold, ("order_id", "unit_price")),
        "anomaly_high_revenue": anomaly_high(anomalies.high_revenue, "revenue"),
        "anomaly_high_quantity": anomaly_high(anomalies.high_quantity, "quantity"),
        "anomaly_high_discount": over_sales(
            lambda sales: anomalies.high_discount(unclamped(sales)), every
        ),
        "anomaly_negative": over_sales(
            lambda sales: anomalies.negative_values(flipped(sales)), every
        ),
        "anomaly_price": anomaly_price,
        "anomaly_records": over_sales(anomaly_plan, every),
        "refresh_report": refresh_report,
        "check_months": over_sales(monthly_plan, monthly.COLUMNS, quality.check_months),
        "check_products": over_sales(
            products.top_products_two_step, products.COLUMNS, quality.check_products
        ),
        "check_regions": over_sales(region_plan, regions.COLUMNS, quality.check_regions),
        "check_share_total": over_sales(region_plan, regions.COLUMNS, quality.check_share_total),
        "check_categories": over_sales(
            discounts.category_discount_median,
            discounts.COLUMNS,
            as_stored("category_discount_map"),
            quality.check_categories,
        ),
        "check_anomalies": over_sales(anomaly_plan, every, quality.check_anomalies),
        "anomaly_listing": over_sales(anomaly_plan, every, quality.anomaly_listing),
        "dash_monthly": over_sales(
            monthly_plan,
            monthly.COLUMNS,
            as_stored("monthly_sales_summary"),
            dashboard.monthly_listing,
        ),
        "dash_top_products": over_sales(
            products.top_products, products.COLUMNS, dashboard.top_products_listing
        ),
        "top5_products": over_sales(
            products.top_products, products.COLUMNS, dashboard.top_products_chart
        ),
        "product_listing": over_sales(
            products.top_products_two_step, products.COLUMNS, dashboard.product_listing
        ),
        "dash_regions": over_sales(region_plan, regions.COLUMNS, dashboard.region_listing),
        "dash_categories": over_sales(
            discounts.category_discount,
            discounts.COLUMNS,
            as_stored("category_discount_map"),
            dashboard.category_listing,
        ),
        "dash_summary": dash_summary,
        "dash_stored": dash_stored,
        "ingest_table": ingest_table,
        "header_ingest": header_ingest,
        "stream_ingest": stream_ingest,
        "strict_rejects": strict_rejects,
        "blank_lines": blank_lines,
        "csv_round_trip": csv_round_trip,
        "bulk_load": bulk_load,
        "bulk_rejects": bulk_rejects,
        "csv_merged": csv_merged,
        "stream_counts": stream_counts,
        "indexed_load": indexed_load,
        **{f"refresh_{name}": refreshed(name) for name in SUMMARY_SCHEMAS},
        "refresh_incremental": refresh_incremental,
        "monthly_distinct": over_sales(
            lambda sales: monthly.monthly_sales(by_order(sales)), ("order_id", *monthly.COLUMNS)
        ),
        "region_distinct": over_sales(
            lambda sales: regions.region_performance(by_order(sales)),
            ("order_id", *regions.COLUMNS),
        ),
        "top_products_nameless": over_sales(
            lambda sales: products.top_products(some_nameless(sales)), products.COLUMNS
        ),
    }


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql() | (llm_queries.oracle_sql() if llm_queries else {})
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

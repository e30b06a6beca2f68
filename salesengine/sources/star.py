"""Sales rows from a star schema of order lines, orders, parts and customers.

``star_sales`` gives clean facts, one per order line; ``star_raw`` gives the
same lines as messy text, duplicates included, and ``star_lines`` as CSV.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_product, clean_region
from ..operators.keyed import first_per_key
from ..schemas import RAW_COLUMNS, SALES_SCHEMA
from ..session import located

# What each column needs beyond the order lines.
_FROM_PART = {"product_name", "category"}
_FROM_ORDERS = {"region", "customer_email"}
_FROM_REGION = {"region"}

_LINE_KEY = ["l_orderkey", "l_linenumber"]
# Total order among lines of one key: lines equal in these give equal sales rows.
_LINE_ORDER = ["l_shipdate", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Files of order lines from this size on have splits enough for all tasks.
SPREAD_BELOW = 256 * 2**20


def _spread(spark: SparkSession, folder: str, lines: DataFrame) -> DataFrame:
    """Narrow lines of a small table dealt to all tasks by their key.

    A file of few row groups is read by as few tasks, which would make and clean all its text.
    The lines of a large table are shuffled by the joins, and not once more before them.
    """
    files, path = located(spark, f"{folder}/lineitem.parquet")
    if files.getContentSummary(path).getLength() >= SPREAD_BELOW:
        return lines
    return lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *_LINE_KEY)


def _joined(spark: SparkSession, folder: str, lines: DataFrame, wanted: set[str]) -> DataFrame:
    """Lines with the tables that ``wanted`` columns come from, and no others.

    Keys of those tables are unique, so an outer join neither adds nor drops
    lines and a join nobody needs can be left out. Orders meet their customers
    before the lines meet them, and texts come last, so the lines are shuffled
    once per large table, as numbers. Join strategies are left to
    Catalyst: it broadcasts a side only below its size threshold, and AQE
    splits hot keys of the others.
    """
    if wanted & _FROM_ORDERS:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
        if wanted & _FROM_REGION:
            customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
            orders = orders.drop("c_custkey")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if wanted & _FROM_PART:
        part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if wanted & _FROM_REGION:
        nation = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
        region = table(spark, folder, "region").select("r_regionkey", "r_name")
        places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        lines = lines.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return lines


def _money(cents: Column, precision: int) -> Column:
    """Whole cents to a decimal of two digits, without a division."""
    return (cents * F.lit(0.01).cast("decimal(3,2)")).cast(f"decimal({precision},2)")


def _whole(total: Column, parts: Column) -> Column:
    """Whole part of a division of non-negative whole numbers."""
    return F.call_function("div", total, parts)


def _slim(lines: DataFrame) -> DataFrame:
    """Order lines with the whole numbers and days that all else is made of.

    The joins shuffle them, and cents, percents and days pack better than doubles and times.
    """
    total = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return lines.select(
        *_LINE_KEY,
        "l_partkey",
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
        F.col("l_quantity").cast("int").alias("l_quantity"),
        _whole(total, F.col("l_quantity").cast("bigint")).alias("l_cents"),
        F.round(F.col("l_discount") * 100).cast("int").alias("l_percent"),
    )


def star_sales(
    spark: SparkSession, folder: str, columns: Iterable[str] = SALES_SCHEMA.names
) -> DataFrame:
    """The fact table, one row per order line key, with just the given columns."""
    columns = list(columns)
    lines = first_per_key(
        table(spark, folder, "lineitem").select(*_LINE_KEY, *_LINE_ORDER), _LINE_KEY, _LINE_ORDER
    )
    quantity, cents, percent = F.col("l_quantity"), F.col("l_cents"), F.col("l_percent")
    revenue_cents = _whole(quantity * cents * (100 - percent) + 50, F.lit(100).cast("bigint"))
    values = {
        "order_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "product_name": clean_product(F.col("p_name")),
        "category": F.lower(F.trim("p_type")),
        "quantity": quantity,
        "unit_price": _money(cents, 10),
        "discount_percent": percent.cast("decimal(5,2)"),
        "region": clean_region(F.col("r_name")),
        # A tenth of the orders has no date and a quarter of the customers no address.
        "sale_date": F.when(F.col("l_orderkey") % 10 != 0, F.col("l_shipdate")),
        "customer_email": F.when(
            F.col("o_custkey") % 4 != 0,
            F.concat(F.lit("customer"), F.col("o_custkey"), F.lit("@example.com")),
        ),
        "revenue": _money(revenue_cents, 12),
    }
    joined = _joined(spark, folder, _slim(lines), set(columns))
    return joined.select(*[values[c].alias(c) for c in columns])


def star_raw(
    spark: SparkSession, folder: str, columns: Iterable[str] = RAW_COLUMNS
) -> DataFrame:
    """Every order line as messy text, with ``_v`` saying how messy."""
    columns = list(columns)
    lines = _spread(spark, folder, _slim(table(spark, folder, "lineitem")))
    v = F.col("_v")
    units, cents = F.col("l_quantity").cast("string"), F.col("l_cents")
    price = F.concat(
        _whole(cents, F.lit(100).cast("bigint")).cast("string"), F.lit("."), F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0")
    )
    percent = F.col("l_percent").cast("string")
    name, kind, place = F.col("p_name"), F.col("p_type"), F.col("r_name")
    shipped = F.col("l_shipdate")
    email = F.concat(F.lit("customer"), F.col("o_custkey"), F.lit("@example.com"))

    def mess(variants: int, *cases: Column | str) -> Column:
        """The case for the remainder of ``_v``; the first one for the rest."""
        chosen = F.when(v % variants == 0, cases[0])
        for i, case in enumerate(cases[1:], start=1):
            chosen = chosen.when(v % variants == i, case)
        return chosen.otherwise(cases[0])

    values = {
        "order_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "product_name": mess(
            5, name, F.concat(F.lit("  "), F.upper(name), F.lit("\t")), "", F.upper(name), "   "
        ),
        "category": mess(
            8,
            kind,
            F.lower(kind),
            "home applicance",
            "Electronic",
            "electronics gadgets",
            "",
            "  FURNITURE ",
            "home electronic items",
        ),
        "quantity": mess(
            7, units, "0", "-5", "abc", F.concat(F.lit(" "), units, F.lit(" ")), "3.0",
            F.concat(F.lit("+"), units),
        ),
        "unit_price": mess(6, price, price, price, F.concat(F.lit("-"), price), "n/a", "1e3"),
        "discount_percent": mess(
            4, (F.pmod(v, F.lit(140)) - 10).cast("string"), percent, "", "99.9"
        ),
        "region": mess(
            6, place, place, "nort", F.concat(F.lit("  "), place, F.lit(" ")), "",
            F.lower(F.col("n_name")),
        ),
        "sale_date": mess(
            8,
            F.date_format(shipped, "yyyy-MM-dd"),
            F.date_format(shipped, "dd/MM/yyyy"),
            F.date_format(shipped, "MM-dd-yyyy"),
            F.date_format(shipped, "MMMM d, yyyy"),
            "",
            F.date_format(shipped, "MM/dd/yyyy"),
            F.concat(F.lit("  "), F.date_format(shipped, "yyyy-MM-dd"), F.lit(" ")),
            "not-a-date",
        ),
        "customer_email": mess(
            5,
            email,
            F.concat(F.lit(" "), email, F.lit(" ")),
            "customer.example.com",
            F.concat(F.lit("customer"), F.col("o_custkey"), F.lit("@example.net")),
            "",
        ),
        "revenue": F.lit("0.0"),
    }
    joined = _joined(spark, folder, lines, set(columns))
    # Not made before the joins, which would shuffle it.
    numbered = joined.withColumn("_v", F.col("l_orderkey") * 7 + F.col("l_linenumber"))
    return numbered.select(*[values[c].alias(c) for c in columns], "_v")


def star_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``star_raw`` as CSV lines in a ``value`` column, some of them malformed.

    Some lines lack the last field, some have one too many, some hold quotes
    or an open quote that swallows the last comma.
    """
    v = F.col("_v")
    raw = star_raw(spark, folder)
    product = F.when(
        v % 17 == 0, F.concat(F.lit('"say ""'), F.col("product_name"), F.lit('"", ok"'))
    ).otherwise(F.col("product_name"))
    quoted_date = F.concat(F.lit('"'), F.col("sale_date"), F.lit('"'))
    open_email = F.concat(F.lit('"'), F.col("customer_email"))
    columns = {c: F.col(c) for c in RAW_COLUMNS}
    columns["product_name"] = product
    columns["sale_date"] = F.when(F.col("sale_date").contains(","), quoted_date).otherwise(
        F.col("sale_date")
    )
    columns["customer_email"] = F.when(v % 19 == 0, open_email).otherwise(F.col("customer_email"))
    head = F.concat_ws(",", *[columns[c] for c in RAW_COLUMNS[:-1]])
    line = (
        F.when(v % 13 == 0, head)
        .when(v % 23 == 0, F.concat(head, F.lit(",0.0,extra")))
        .otherwise(F.concat(head, F.lit(",0.0")))
    )
    return raw.select(line.alias("value"))

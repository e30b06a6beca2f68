"""Synthetic messy order files of any size, the same for the same seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS

# The spellings, formats and the ring size of the sample data.
PRODUCT_NAMES = (
    "Smartphone", "Smart phone", "SMARTPHONE", "smart phone",
    "Laptop", "Lap top", "LAPTOP", "laptop computer",
    "Washing Machine", "Washing machine", "washing machine", "WASHING MACHINE",
    "Chair", "Chair set", "CHAIR", "office chair",
    "Television", "TV", "tv", "TELEVISION",
    "Refrigerator", "Fridge", "FRIDGE", "refridgerator",
)
CATEGORIES = (
    "electronics", "Electronics", "ELECTRONICS", "electronic",
    "home appliance", "Home Appliance", "home applicance", "HOME APPLIANCE",
    "furniture", "Furniture", "FURNITURE", "furnishing",
    "gadgets", "Gadgets", "electronics gadgets",
)
REGIONS = (
    "North", "nort", "NORTH", "north", "South", "south",
    "East", "east", "West", "west",
)
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM-dd-yyyy", "MMMM d, yyyy")
ID_RING = 10_000
REPEAT_PERCENT = 10


def _draw(seed: int, what: str, low: int, high: int, row: Column | None = None) -> Column:
    """Whole number in [low, high], a pure function of seed, purpose and row."""
    row = F.col("id") if row is None else row
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(what), row), F.lit(high - low + 1)) + low


def _pick(seed: int, what: str, values: tuple[str, ...]) -> Column:
    return F.element_at(
        F.array(*map(F.lit, values)), _draw(seed, what, 1, len(values)).cast("int")
    )


def _repeats(seed: int, row: Column) -> Column:
    return (row >= ID_RING) & (_draw(seed, "repeat", 0, 99, row) < REPEAT_PERCENT)


def _order_id(seed: int) -> Column:
    """A tenth of the rows past the ring take the id of an earlier row.

    The earlier row sits at a drawn place in the ring; when it repeats an id
    itself, the row one ring before it is taken. Rows of the first ring never repeat.
    """
    row = F.col("id")
    slot = _draw(seed, "slot", 0, ID_RING - 1)
    last = row - 1 - F.pmod(row - 1 - slot, F.lit(ID_RING))
    earlier = F.coalesce(
        *[
            F.when((last - k * ID_RING >= 0) & ~_repeats(seed, last - k * ID_RING), last - k * ID_RING)
            for k in range(3)
        ],
        slot,
    )
    owner = F.when(_repeats(seed, row), earlier).otherwise(row)
    alphabet = F.conv(F.hex(F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("order"), owner), 1)), 16, 36)
    return F.right(F.lpad(alphabet, 13, "0"), F.lit(10))


def generate_sales(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    """``rows`` raw orders as ten text columns."""
    mode = _draw(seed, "mode", 0, 2)
    quantity = (
        F.when(mode == 0, _draw(seed, "wide", -5, 20))
        .when(mode == 1, 0)
        .otherwise(_draw(seed, "narrow", 1, 5))
    )
    price = _draw(seed, "price", 500, 50_000) / 100
    discount = _draw(seed, "discount", 0, 120)
    day = F.date_add(F.make_date(F.lit(2020), F.lit(1), F.lit(1)), _draw(seed, "day", 0, 1460).cast("int"))
    shown = F.element_at(
        F.array(*[F.date_format(day, f) for f in DATE_FORMATS]),
        _draw(seed, "format", 1, len(DATE_FORMATS)).cast("int"),
    )
    email = F.concat(F.lit("customer"), _draw(seed, "email", 1000, 9999), F.lit("@example.com"))
    # The discount is read as a fraction here and dropped above 1, so this
    # column disagrees with the cleaned revenue; cleaning never reads it.
    revenue = F.round(quantity * price * F.when(discount <= 1, 1 - discount).otherwise(1), 2)
    values = (
        _order_id(seed),
        _pick(seed, "product", PRODUCT_NAMES),
        _pick(seed, "category", CATEGORIES),
        quantity,
        price,
        discount,
        _pick(seed, "region", REGIONS),
        F.when(_draw(seed, "undated", 0, 9) == 0, "").otherwise(shown),
        F.when(_draw(seed, "silent", 0, 3) == 0, "").otherwise(email),
        revenue,
    )
    return spark.range(rows).select(
        *[value.cast("string").alias(name) for value, name in zip(values, RAW_COLUMNS, strict=True)]
    )


def write_sample(spark: SparkSession, rows: int, path: str, seed: int = 42) -> None:
    """A folder of CSV files with headers."""
    orders = generate_sales(spark, rows, seed)
    orders.write.option("header", True).option("escape", '"').option("emptyValue", "").csv(path)

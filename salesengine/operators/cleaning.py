"""Raw text rows to cleaned rows, rejected lines, and fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_date
from ..functions.numbers import (
    clean_discount,
    clean_double,
    clean_quantity,
    revenue_cents,
    round_half_up,
)
from ..functions.text import clean_category, clean_email, clean_product, clean_region
from ..schemas import RAW_COLUMNS, SALES_SCHEMA, VARCHAR_LENGTHS
from ..sources.csv_lines import raw_row

TOO_FEW_FIELDS = "insufficient columns"
BLANK_LINE = "blank line"
DOES_NOT_FIT = "does not fit the table"
KEY = "order_id"


def clean_sales(raw: DataFrame, keep: tuple[str, ...] = (), bare: bool = False) -> DataFrame:
    """Ten text columns to a cleaned row; ``keep`` passes other columns through.

    ``bare`` says that the texts have no blanks at their edges.
    """
    parsed = raw.select(
        "order_id",
        clean_product(F.col("product_name"), bare).alias("product_name"),
        clean_category(F.col("category"), bare).alias("category"),
        clean_quantity(F.col("quantity"), bare).alias("quantity"),
        clean_double(F.col("unit_price"), bare).alias("unit_price"),
        clean_double(F.col("discount_percent"), bare).alias("discount_percent"),
        clean_region(F.col("region"), bare).alias("region"),
        parse_date(F.col("sale_date")).alias("sale_date"),
        clean_email(F.col("customer_email"), bare).alias("customer_email"),
        *keep,
    )
    clamped = parsed.withColumn("discount_percent", clean_discount(F.col("discount_percent")))
    cents = clamped.withColumn(
        "revenue", revenue_cents(*map(F.col, ("quantity", "unit_price", "discount_percent")))
    )
    earned = round_half_up(F.col("revenue")) / F.lit(100.0)
    return cents.select(*RAW_COLUMNS[:-1], earned.alias("revenue"), *keep)


def too_narrow() -> Column:
    return F.size("fields") < len(RAW_COLUMNS)


def wide_enough(fields: DataFrame) -> DataFrame:
    """Rows with all ten fields; more are allowed and ignored."""
    return fields.where(~too_narrow())


def _reject(rows: DataFrame, reason: Column) -> DataFrame:
    file = F.col("_file") if "_file" in rows.columns else F.lit(None).cast("string")
    return rows.select(F.col("value").alias("line"), reason.alias("reason"), file.alias("file"))


def rejected(fields: DataFrame) -> DataFrame:
    """Lines with too few fields, with the reason and the file they came from."""
    blank = F.trim("value") == ""
    reason = F.when(blank, BLANK_LINE).otherwise(TOO_FEW_FIELDS)
    return _reject(fields.where(too_narrow()), reason)


def rejected_as_unfit(fields: DataFrame, truncate: bool = False) -> DataFrame:
    """Lines whose cleaned row does not fit the fact types."""
    kept = tuple(c for c in ("value", "_file") if c in fields.columns)
    unfit = _where_settled(split_and_clean(fields, kept), does_not_fit(truncate))
    return _reject(unfit, F.lit(DOES_NOT_FIT))


def fitting(clean: DataFrame, truncate: bool = False) -> DataFrame:
    """Cleaned rows that fit the fact types."""
    return _where_settled(clean, ~does_not_fit(truncate))


def _where_settled(clean: DataFrame, condition: Column) -> DataFrame:
    """Rows by a condition on their cleaned values, which are computed once.

    A row number stands beside the values, so the condition cannot sink below
    them and repeat the cleaning, in code too long to compile.
    """
    numbered = clean.withColumn("_once", F.monotonically_increasing_id())
    return numbered.where((F.col("_once") >= 0) & condition).drop("_once")


def judged(fields: DataFrame, keep: tuple[str, ...] = (), truncate: bool = False) -> DataFrame:
    """Every split line once: its fact row, or else ``line``, the ``reason`` and the ``file``.

    For loads, which store the frame and take rows and rejects from it, so that no line is
    split or cleaned twice.
    """
    more = tuple(dict.fromkeys((*keep, "value", "_file", "_narrow")))
    raw = fields.withColumn("_narrow", too_narrow()).select(*raw_row(F.col("fields")), *more)
    blank = F.trim("value") == ""
    reason = F.when(F.col("_narrow"), F.when(blank, BLANK_LINE).otherwise(TOO_FEW_FIELDS)).when(
        does_not_fit(truncate), DOES_NOT_FIT
    )
    known = clean_sales(raw, more, bare=True).withColumn("reason", reason)
    good = F.col("reason").isNull()
    rows = [F.when(good, value).alias(name) for name, value in _stored(truncate).items()]
    return known.select(
        *rows, *keep, F.when(~good, F.col("value")).alias("line"), "reason",
        F.when(~good, F.col("_file")).alias("file"),
    )


def all_rejects(fields: DataFrame, truncate: bool = False) -> DataFrame:
    return rejected(fields).unionByName(rejected_as_unfit(fields, truncate))


def split_and_clean(fields: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines split into ``fields`` to cleaned rows."""
    raw = wide_enough(fields).select(*raw_row(F.col("fields")), *keep)
    return clean_sales(raw, keep, bare=True)


def to_stored(clean: DataFrame, keep: tuple[str, ...] = (), truncate: bool = False) -> DataFrame:
    """Cleaned rows to fact types.

    Rows that do not fit are to be set aside before. With ``truncate`` texts are
    cut, numbers clamped and NaN made NULL; the key is never cut.
    """
    return clean.select(*[value.alias(name) for name, value in _stored(truncate).items()], *keep)


def _stored(truncate: bool) -> dict[str, Column]:
    if truncate:
        return {f.name: _shortened(F.col(f.name), f) for f in SALES_SCHEMA.fields}
    return {f.name: F.col(f.name).cast(f.dataType) for f in SALES_SCHEMA.fields}


def does_not_fit(truncate: bool = False) -> Column:
    """True for rows to set aside: with ``truncate`` those whose key is too long alone."""
    tests = []
    for f in SALES_SCHEMA.fields:
        value = F.col(f.name)
        if truncate and f.name != KEY:
            continue
        if f.name in VARCHAR_LENGTHS:
            tests.append(F.coalesce(F.length(value) > VARCHAR_LENGTHS[f.name], F.lit(False)))
        elif isinstance(f.dataType, T.DecimalType):
            number = value.cast("double")
            tests.append(F.isnan(number) | F.coalesce(F.abs(number) > _limit(f), F.lit(False)))
    changed = tests[0]
    for test in tests[1:]:
        changed = changed | test
    return changed


def _limit(column: T.StructField) -> float:
    kind = column.dataType
    return float(10 ** (kind.precision - kind.scale)) - 10.0**-kind.scale


def _shortened(value: Column, column: T.StructField) -> Column:
    if column.name in VARCHAR_LENGTHS and column.name != KEY:
        value = F.substring(value, 1, VARCHAR_LENGTHS[column.name])
    elif isinstance(column.dataType, T.DecimalType):
        limit = F.lit(_limit(column))
        number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
        value = F.when(number.isNotNull(), F.greatest(F.least(number, limit), -limit))
    return value.cast(column.dataType).alias(column.name)

"""Parsing of numeric fields, revenue, and exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trimmed

MAX_DISCOUNT_PERCENT = 70


def clean_quantity(text: Column, bare: bool = False) -> Column:
    """Not a 32-bit integer gives 0; anything below 1 gives 1."""
    value = trimmed(text, bare)
    # Digits are checked first: a cast that fails costs an exception per row.
    long = F.when(value.rlike(r"^[+-]?0*[0-9]{1,10}$"), value.cast("bigint"))
    parsed = long.try_cast("int")
    return F.when(parsed < 1, 1).otherwise(F.coalesce(parsed, F.lit(0)))


def clean_double(text: Column, bare: bool = False) -> Column:
    """Not a number gives 0.0. Special values count only as NaN and Infinity."""
    value = trimmed(text, bare)
    # Blanks and words never reach the cast, which would throw and catch for each.
    likely = value.rlike("[0-9]|^[+-]?(?:NaN|Infinity)$")
    return F.coalesce(F.when(likely, value.try_cast("double")), F.lit(0.0))


def clean_discount(percent: Column) -> Column:
    """Clamp to [0, 70]; NaN stays NaN, which Spark would sort above 70."""
    return (
        F.when(percent < 0, 0.0)
        .when((percent > MAX_DISCOUNT_PERCENT) & ~F.isnan(percent), float(MAX_DISCOUNT_PERCENT))
        .otherwise(percent)
    )


def round_half_up(value: Column) -> Column:
    """Nearest long, halves towards +infinity; F.round would move -0.5 to -1.

    Doubles from 2^52 on are whole already and go through floor alone.
    """
    low = F.floor(value)
    step = F.when(value - low >= 0.5, 1).otherwise(0)
    return F.when(F.abs(value) < float(2**52), low + step).otherwise(low)


def revenue_cents(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    return quantity * unit_price * (F.lit(100) - discount_percent)


def revenue(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    return round_half_up(revenue_cents(quantity, unit_price, discount_percent)) / F.lit(100.0)


def exact_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """A division of whole numbers, rounded half up in size once, however large they are.

    Twice the numerator in units of the last digit plus the denominator, divided by twice the
    denominator without remainder; all of it in decimals of 38 digits.
    """
    whole = "decimal(38,0)"
    top, below = F.abs(numerator.cast(whole)), F.abs(F.nullif(denominator, F.lit(0)).cast(whole))
    units = (top * F.lit(2 * 10**digits).cast("decimal(12,0)")).cast(whole) + below
    quotient = F.call_function("div", units.cast(whole), (below * 2).cast(whole))
    sign = F.when((numerator < 0) != (denominator < 0), -1).otherwise(1)
    last = F.lit(f"{10.0**-digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    return ((sign * quotient).cast("decimal(19,0)") * last).cast(f"decimal({20 + digits},{digits})")


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """A decimal of two digits by a whole number, rounded half up once at any size."""
    cents = (numerator.cast("decimal(34,2)") * 100).cast("decimal(38,0)")
    return exact_ratio(cents, (denominator * 100).cast("decimal(38,0)"), digits)


def mean(value: Column, digits: int, wide: str = "decimal(10,2)") -> Column:
    """Average of a two-digit decimal from an exact sum.

    Avg over decimals would round at the fourth digit first, and over doubles
    would depend on the order of the rows.
    """
    return ratio(F.sum(value.cast(wide)), F.count(value), digits)

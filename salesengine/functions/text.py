"""Cleaning of text fields.

Cleaners name their input as few times as they can: Spark copies the expression
behind it each time, and raw text may be long-winded. ``bare`` says that the
edges carry no blanks, as with fields of a split line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character up to and including the space counts as blank, so tabs and
# line ends at the edges go too; F.trim alone would strip spaces only.
BLANKS = "".join(chr(code) for code in range(0x21))

COMPASS = {"n": "North", "e": "East", "w": "West", "s": "South"}


def trimmed(text: Column, bare: bool = False) -> Column:
    return text if bare else F.btrim(text, F.lit(BLANKS))


def trimmed_fast(text: Column) -> Column:
    """The same for a plain column: most texts have clean ends, and a look at them is cheap."""
    clean_ends = (F.ascii(text) > 32) & (F.ascii(F.right(text, F.lit(1))) > 32)
    return F.when(clean_ends, text).otherwise(trimmed(text))


def _or_default(text: Column, default: str) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def clean_product(text: Column, bare: bool = False) -> Column:
    return _or_default(F.lower(trimmed(text, bare)), "Unknown Product")


def clean_category(text: Column, bare: bool = False) -> Column:
    spelled = F.replace(F.lower(trimmed(text, bare)), F.lit("applicance"), F.lit("appliance"))
    merged = F.regexp_replace(spelled, "electronic.*", "electronics")
    return _or_default(merged, "uncategorized")


def clean_region(text: Column, bare: bool = False) -> Column:
    # The first character is taken before trimming: '  North' is not 'North'.
    compass = F.create_map(*[F.lit(x) for pair in COMPASS.items() for x in pair])
    initial = F.lower(F.substring(text, 1, 1))
    return F.coalesce(
        F.try_element_at(compass, initial), _or_default(F.lower(trimmed(text, bare)), "unknown")
    )


def clean_email(text: Column, bare: bool = False) -> Column:
    return F.when(text.contains("@") & text.contains(".com"), trimmed(text, bare))

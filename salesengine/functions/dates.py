"""Dates from free text, and labels for months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trimmed

# The accepted formats, tried in this order, so 05/06/2024 is in June.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "MM-dd-yyyy", "MMMM d, yyyy")

# Numbers may be short or zero-padded, blanks may precede a number and any text
# may follow the last one. Ranges are in the patterns and the rest is left to a
# cast, so a text that is no date costs a failed match and never an exception.
_PAD = r"[ \t]*0*"
_YEAR = rf"{_PAD}([1-9]\d{{0,3}})"
_MONTH = rf"{_PAD}(1[0-2]|[1-9])"
_DAY = rf"{_PAD}(3[01]|[12]\d|[1-9])"
_START, _END = r"^[\x00-\x20]*", r"(?!\d).*"
_MONTH_NAMES = (
    "january|february|march|april|may|june|july|august|september|october|november|december"
    "|jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec"
)
_YEAR_FIRST = rf"{_YEAR}-{_MONTH}-{_DAY}"
_DAY_FIRST = rf"{_DAY}/{_MONTH}/{_YEAR}"
_MONTH_FIRST = rf"{_MONTH}/{_DAY}/{_YEAR}"
_YEAR_LAST = rf"{_MONTH}-{_DAY}-{_YEAR}"
_NAMED = rf"(?is){_START}(?=(?:{_MONTH_NAMES}) )([a-z]{{3}})[a-z]* {_DAY}, {_YEAR}{_END}"


def _spelled(text: Column, pattern: str, year_month_day: str) -> Column:
    """The date the groups of ``pattern`` spell, with years of four digits or more.

    The second alternative takes every other text and leaves the groups empty,
    which is no date; the text is named, and matched, once.
    """
    whole = rf"(?s){_START}(?:{pattern}{_END}|.*)$"
    return F.regexp_replace(text, whole, year_month_day).try_cast("date")


def _first_spelled(text: Column, mark: str, *formats: tuple[str, str]) -> Column:
    """The first format that fits; a text without their ``mark`` is not matched against any."""
    return F.when(text.contains(mark), F.coalesce(*[_spelled(text, *f) for f in formats]))


def str_to_date(text: Column) -> Column:
    """Year, month, day with dashes; NULL when it is no date."""
    return _spelled(text, _YEAR_FIRST, "000$1-$2-$3")


def parse_date(text: Column, strict: bool = False) -> Column:
    """First format that fits. ``strict`` takes the five formats literally."""
    if strict:
        value = trimmed(text)
        found = F.coalesce(*[F.try_to_date(value, f) for f in DATE_FORMATS])
        return F.when(F.year(found) >= 1, found)
    named = F.initcap(F.lower(F.regexp_replace(text, _NAMED, "$1 $2, $3")))
    return F.coalesce(
        _first_spelled(text, "-", (_YEAR_FIRST, "000$1-$2-$3")),
        _first_spelled(text, "/", (_DAY_FIRST, "000$3-$2-$1"), (_MONTH_FIRST, "000$3-$1-$2")),
        _first_spelled(text, "-", (_YEAR_LAST, "000$3-$1-$2")),
        F.when(text.contains(", ") & text.rlike(_NAMED), F.try_to_date(named, "MMM d, y")),
    )


def month_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)

"""Numbers out of messy feed text, and rounding for display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_int(text: Column) -> Column:
    """Positive whole number in a text: cut at the first comma, keep digits; else NULL."""
    digits = F.regexp_replace(F.split_part(text, F.lit(","), F.lit(1)), r"[^0-9]", "")
    return positive(F.nullif(digits, F.lit("")).try_cast("bigint"))


def positive(number: Column) -> Column:
    """Whole part of a number when above zero, else NULL."""
    whole = number.try_cast("bigint")
    return F.when(whole > 0, whole)


def first_int(texts: Column) -> Column:
    """`as_int` of a list's first entry."""
    return as_int(F.get(texts, F.lit(0)))


def none_if_zero(number: Column) -> Column:
    return F.when(number != 0, number)


def percent(ratio: Column, digits: int = 1) -> Column:
    """A ratio as a rounded percentage; NULL stays NULL."""
    return F.round(ratio * 100, digits)

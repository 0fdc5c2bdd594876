"""Dates out of feeds, and the calendar keys reports group by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An integer above the floor is an epoch, and no year beyond 9999 is printed.
EPOCH_FLOOR = 10_000_000
LAST_EPOCH_SECOND = 253_402_300_799
SECONDS_PER_DAY = 86_400


def iso_date(value: Column, unit: str = "s") -> Column:
    """Epoch text or a leading ISO date to `yyyy-MM-dd` text; '' when neither.

    `unit` is `s` or `ms`, for feeds whose epoch is known to be in milliseconds.
    """
    text = F.regexp_replace(value.cast("string"), r"(?U)\A\s+|\s+\z", "")
    number = F.when(text.rlike(r"\A[+-]?\d+(_\d+)*\z"), F.replace(text, F.lit("_"), F.lit("")))
    epoch = number.try_cast("bigint")
    is_epoch = epoch > EPOCH_FLOOR
    seconds = F.floor(epoch / 1000).cast("bigint") if unit == "ms" else epoch
    in_range = seconds.between(0, LAST_EPOCH_SECOND)
    # the division sees a guarded operand only, so no cast can overflow under ANSI
    days = F.floor(F.when(in_range, seconds) / SECONDS_PER_DAY).cast("int")
    from_epoch = F.when(in_range, F.date_format(F.date_from_unix_date(days), "yyyy-MM-dd"))
    from_text = F.regexp_extract(F.coalesce(text, F.lit("")), r"\A(\d{4}-\d{2}-\d{2})", 1)
    too_long = number.isNotNull() & epoch.isNull()
    return (
        F.when(too_long, F.lit(""))
        .when(is_epoch, F.coalesce(from_epoch, F.lit("")))
        .otherwise(from_text)
    )


def feed_date(value: Column, unit: str = "s") -> Column:
    """`iso_date` as a DATE, NULL when unknown."""
    return iso_date(value, unit).try_cast("date")


def rfc822_date(value: Column) -> Column:
    """The calendar day written in an RSS date, as ISO text; '' when malformed.

    The day is taken as printed, in whatever zone the feed states.
    """
    shape = (
        r"\A\s*(?:[A-Za-z]+\s*,\s*)?(\d{1,2})[\s-]+([A-Za-z]{3})[a-z]*\.?[\s-]+(\d{4}|\d{2})\s+"
        r"(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?(?:\s.*)?\z"
    )
    text = F.coalesce(value, F.lit(""))
    day, month, year = (F.regexp_extract(text, shape, i) for i in (1, 2, 3))
    full_year = F.when(
        F.length(year) == 2,
        F.concat(F.when(year.try_cast("int") < 69, F.lit("20")).otherwise(F.lit("19")), year),
    ).otherwise(year)
    plain = F.when(
        day != "", F.concat_ws(" ", day, F.initcap(month), full_year)
    )
    parsed = F.try_to_date(plain, "d MMM yyyy")
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit(""))


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def year_key(day: Column) -> Column:
    return F.date_format(day, "yyyy")


def month_of_year(day: Column) -> Column:
    return F.date_format(day, "MM")


def short_month_label(day: Column) -> Column:
    """Axis label such as `Jun/23`."""
    return F.date_format(day, "MMM/yy")


def days_before(today: str, days: int) -> Column:
    return F.date_sub(F.lit(today).cast("date"), days)

"""Calendar arithmetic with the boundary-counting rules of the source system."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_of_year_us(d: Column) -> Column:
    """Week 1 holds January 1; weeks start on Sunday."""
    first_weekday = F.dayofweek(F.trunc(d, "year"))
    return (F.floor((F.dayofyear(d) + first_weekday - 2) / 7) + 1).cast("int")


def week_start(d: Column) -> Column:
    """Monday of the week, where a Sunday already counts to the next week."""
    return F.trunc(F.date_add(d, 1), "week")


def week_end(d: Column) -> Column:
    return F.date_add(week_start(d), 6)


def period_start(d: Column, part: str) -> Column:
    return week_start(d) if part == "week" else F.trunc(d, part)


def period_end(d: Column, part: str) -> Column:
    """Last day of the week, month, quarter or year that holds the date."""
    if part == "week":
        return week_end(d)
    months = {"month": 1, "quarter": 3, "year": 12}[part]
    return F.date_sub(F.add_months(F.trunc(d, part), months), 1)


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, not elapsed time."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", F.date_trunc("second", start), F.date_trunc("second", end))


def timestamp_of_ints(ymd: Column, hms: Column) -> Column:
    """Timestamp of integer YYYYMMDD and HHMMSS fields."""

    def digits(c: Column, divisor: int) -> Column:
        return F.floor(c / divisor).cast("int") % 100

    return F.make_timestamp_ntz(
        F.floor(ymd / 10000).cast("int"), digits(ymd, 100), digits(ymd, 1),
        digits(hms, 10000), digits(hms, 100), digits(hms, 1),
    )


def month_name(d: Column) -> Column:
    return F.lower(F.date_format(d, "MMMM"))


def month_short_name(d: Column) -> Column:
    return F.lower(F.date_format(d, "MMM"))


def weekday_name(d: Column) -> Column:
    return F.lower(F.date_format(d, "EEEE"))


def weekday_short_name(d: Column) -> Column:
    return F.lower(F.date_format(d, "EEE"))


def month_year_label(d: Column) -> Column:
    return F.concat(month_short_name(d), F.lit("/"), F.year(d).cast("string"))

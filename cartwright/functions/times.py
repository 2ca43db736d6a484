"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dated(c: Column) -> Column:
    """The text if it starts with a year; a bare time would be read as today's."""
    only_year = (F.length(c) == 4) & ~c.contains(":")
    return F.when((F.substring(c, 5, 1) == "-") | only_year, c)


def to_utc(c: Column) -> Column:
    """Parse to a timestamp in the session zone (UTC); bad text becomes null."""
    return _dated(c).try_cast("timestamp")


def to_day(c: Column) -> Column:
    """Parse to a date; bad text becomes null."""
    return _dated(c).try_cast("date")


def date_key(c: Column) -> Column:
    """The day as a ``YYYYMMDD`` integer."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def padded_name(c: Column, pattern: str, pad: bool = True) -> Column:
    """A day or month name, blank-padded to nine characters unless told not to."""
    name = F.date_format(c, pattern)
    return F.rpad(name, 9, " ") if pad else name


def sunday_based_weekday(c: Column) -> Column:
    """Day of the week with Sunday as 0."""
    return F.dayofweek(c) - 1


def month_start(c: Column) -> Column:
    return F.trunc(c, "month")


def quarter_start(c: Column) -> Column:
    return F.trunc(c, "quarter")


def calendar_columns(day: Column, pad: bool = True) -> dict[str, Column]:
    """The twelve attributes of a date dimension row."""
    weekday = sunday_based_weekday(day)
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_week": weekday.cast("smallint"),
        "day_name": padded_name(day, "EEEE", pad),
        "day_of_month": F.dayofmonth(day).cast("smallint"),
        "day_of_year": F.dayofyear(day).cast("smallint"),
        "week_of_year": F.weekofyear(day).cast("smallint"),
        "month_number": F.month(day).cast("smallint"),
        "month_name": padded_name(day, "MMMM", pad),
        "quarter": F.quarter(day).cast("smallint"),
        "year": F.year(day).cast("smallint"),
        "is_weekend": weekday.isin(0, 6),
    }

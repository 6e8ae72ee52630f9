"""Calendar parts of a timestamp. All of them follow the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def iso_week(ts: Column) -> Column:
    """ISO week number; it does not follow the calendar year, so never group by (year, week)."""
    return F.weekofyear(ts)


def week_start(ts: Column) -> Column:
    """The Monday of the week, as a date (readable as a directory key)."""
    return F.to_date(F.date_trunc("week", ts))


def year_month(ts: Column) -> dict[str, Column]:
    return {"year": F.year(ts), "month": F.month(ts)}


def calendar_columns(ts: Column) -> dict[str, Column]:
    """The three columns the analysis frame adds to the cleaned table."""
    return {"day_of_week": weekday_name(ts), "date": F.to_date(ts), "week_of_year": iso_week(ts)}


def period_label(year: Column, month: Column) -> Column:
    """``YYYY-MM`` text."""
    return F.format_string("%d-%02d", year, month)

"""Row filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def years_between(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Both years included. Give the partition column and other years are not even listed."""
    return df.filter(F.col(year).between(first, last))


def _bound(df: DataFrame, column: str, value: datetime) -> Column:
    # A literal of the column's own type: a cast on the column would not reach the Parquet scan.
    ntz = isinstance(df.schema[column].dataType, T.TimestampNTZType)
    return F.lit(value).cast("timestamp_ntz" if ntz else "timestamp")


def _months_between(df: DataFrame, low: Column, high: Column) -> DataFrame:
    """Keep the (year, month) directories that can hold rows of a time range.

    A day of margin on both sides covers tables written under another session zone.
    """
    if not {"year", "month"} <= set(df.columns):
        return df
    month_no = F.col("year") * 12 + F.col("month")
    first, last = F.date_sub(low.cast("date"), 1), F.date_add(high.cast("date"), 1)
    return df.filter(
        month_no.between(F.year(first) * 12 + F.month(first), F.year(last) * 12 + F.month(last))
    )


def event_time_slice(df: DataFrame, event_time: str, low: datetime, high: datetime) -> DataFrame:
    """Rows of the half-open range ``[low, high)``; prunes directories, then row groups."""
    low_col, high_col = _bound(df, event_time, low), _bound(df, event_time, high)
    ts = F.col(event_time)
    return _months_between(df, low_col, high_col).filter((ts >= low_col) & (ts < high_col))


def window_slice(windows: DataFrame, low: datetime, high: datetime) -> DataFrame:
    """Windows that start in ``[low, high)``, in time order."""
    start = F.col("window_start")
    return windows.filter(
        (start >= _bound(windows, "window_start", low))
        & (start < _bound(windows, "window_start", high))
    ).orderBy("window_start")

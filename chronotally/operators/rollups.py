"""Aggregations over timestamped records.

Every one is a plain group-by: Spark aggregates inside each task first, so a group that holds a
third of all rows still sends one row per task through the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronotally.functions.calendar import calendar_columns, period_label, week_start, year_month


def with_calendar(df: DataFrame, event_time: str) -> DataFrame:
    """Add ``day_of_week``, ``date`` and ``week_of_year``."""
    return df.withColumns(calendar_columns(F.col(event_time)))


def _with_year_month(df: DataFrame, event_time: str | None) -> DataFrame:
    """Use the stored partition columns; derive them only where a table has none."""
    if {"year", "month"} <= set(df.columns):
        return df
    if event_time is None:
        raise ValueError("the table has no year and month columns: name its event time")
    return df.withColumns(year_month(F.col(event_time)))


def sums(named: Mapping[str, str], null_as_zero: bool = False) -> list[Column]:
    """``{output: column}`` to sums. A group without a single value sums to NULL, or to zero."""
    total = {out: F.sum(col) for out, col in named.items()}
    return [
        (F.coalesce(t, F.lit(0)) if null_as_zero else t).alias(out) for out, t in total.items()
    ]


def tumbling_windows(
    df: DataFrame,
    event_time: str,
    measures: Mapping[str, str],
    size: str = "1 hour",
    count: str = "records",
    ordered: bool = False,
    null_as_zero: bool = False,
) -> DataFrame:
    """Count and sums per fixed window, for batch and streaming frames alike.

    Windows are aligned to the epoch in UTC whatever the session zone. Rows without an event
    time belong to no window.
    """
    out = (
        df.groupBy(F.window(event_time, size))
        .agg(F.count("*").alias(count), *sums(measures, null_as_zero))
        .select(
            count,
            *measures,
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )
    return out.orderBy("window_start") if ordered else out


def count_by_date(df: DataFrame, event_time: str, count: str = "crash_count") -> DataFrame:
    return (
        df.groupBy(F.to_date(event_time).alias("date"))
        .agg(F.count("*").alias(count))
        .orderBy("date")
    )


def count_by_week(df: DataFrame, event_time: str, count: str = "crash_count") -> DataFrame:
    """By the week's Monday: an ISO week number alone would mix years."""
    return (
        df.groupBy(week_start(F.col(event_time)).alias("week_start"))
        .agg(F.count("*").alias(count))
        .orderBy("week_start")
    )


def count_by_month(
    df: DataFrame, event_time: str | None = None, count: str = "crash_count"
) -> DataFrame:
    return (
        _with_year_month(df, event_time)
        .groupBy("year", "month")
        .agg(F.count("*").alias(count))
        .orderBy("year", "month")
    )


def count_by_month_and(
    df: DataFrame, category: str, event_time: str | None = None, count: str = "crash_count"
) -> DataFrame:
    """A category over time, e.g. the primary cause."""
    return (
        _with_year_month(df, event_time)
        .groupBy("year", "month", category)
        .agg(F.count("*").alias(count))
        .orderBy("year", "month", category)
    )


def sums_by_month(
    df: DataFrame,
    measures: Mapping[str, str],
    event_time: str | None = None,
    count: str = "crash_count",
    null_as_zero: bool = False,
) -> DataFrame:
    return (
        _with_year_month(df, event_time)
        .groupBy("year", "month")
        .agg(*sums(measures, null_as_zero), F.count("*").alias(count))
        .orderBy("year", "month")
    )


def breakdown(df: DataFrame, category: str, count: str = "crash_count") -> DataFrame:
    """Rows per category, largest first, equal counts by name. NULL is a category."""
    return (
        df.groupBy(category)
        .agg(F.count("*").alias(count))
        .orderBy(F.desc(count), F.asc_nulls_last(category))
    )


def rows_by_year(df: DataFrame, event_time: str | None = None, count: str = "count") -> DataFrame:
    return (
        _with_year_month(df, event_time).groupBy("year").agg(F.count("*").alias(count)).orderBy("year")
    )


def distinct_years(df: DataFrame, event_time: str | None = None) -> DataFrame:
    return _with_year_month(df, event_time).select("year").distinct()


def monthly_series(months: DataFrame) -> DataFrame:
    """Add the ``period`` label and put months in time order."""
    return months.withColumn("period", period_label(F.col("year"), F.col("month"))).orderBy("period")


def run_summary(
    df: DataFrame,
    event_time: str,
    elapsed_seconds: float | None = None,
    outputs: Sequence[str] | None = None,
) -> DataFrame:
    """One row: first and last event time and the row count, all from a single pass; with the
    run's outputs and the time it took where they are given."""
    out = df.agg(
        F.min(event_time).alias("first_event"),
        F.max(event_time).alias("last_event"),
        F.count("*").alias("rows_processed"),
    )
    return with_run(out, elapsed_seconds, outputs)


def with_run(
    summary: DataFrame, elapsed_seconds: float | None = None, outputs: Sequence[str] | None = None
) -> DataFrame:
    """A summary with what a run wrote and the time it took, where they are given."""
    if outputs is not None:
        summary = summary.withColumn("outputs", F.array(*map(F.lit, outputs)))
    if elapsed_seconds is not None:
        summary = summary.withColumn("elapsed_seconds", F.lit(float(elapsed_seconds)))
    return summary


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows by an order: a top-n per task, not a full sort."""
    return df.orderBy(*order).limit(n)

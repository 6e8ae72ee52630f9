"""Data-quality checks. Each gives rows ``{check, passed, n_bad, detail}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotally.operators.rollups import first_rows

# Label, and the aggregate that counts the bad rows.
Check = tuple[str, Column]


def columns_required(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the named columns, in that order; refuse a table that lacks one, before any job."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*names)


def _report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check, all counted in one pass."""
    counted = df.agg(F.count("*").alias("rows"), *[bad.alias(f"bad_{i}") for i, (_, bad) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(label).alias("check"),
            (F.col(f"bad_{i}") == 0).alias("passed"),
            F.col(f"bad_{i}").alias("n_bad"),
            F.concat(F.col(f"bad_{i}"), F.lit(" of "), F.col("rows"), F.lit(" rows")).alias("detail"),
        )
        for i, (label, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _is_ntz(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def _seconds(df: DataFrame, column: str) -> Column:
    """Whole seconds since the epoch; for zone-less times, of the written clock time."""
    ts = F.col(column)
    if not _is_ntz(df, column):
        return F.unix_timestamp(ts)
    return (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def _off_grid(windows: DataFrame, size_seconds: int) -> Column:
    """Windows are cut on the UTC epoch. A clock in a half-hour zone shows an hour window at :30,
    so only zone-less times are judged by their minute and second."""
    if size_seconds == 3600 and _is_ntz(windows, "window_start"):
        return (F.minute("window_start") != 0) | (F.second("window_start") != 0)
    return F.pmod(_seconds(windows, "window_start"), F.lit(size_seconds)) != 0


def misaligned(windows: DataFrame, size_seconds: int = 3600) -> DataFrame:
    """Windows that do not start at a multiple of their size."""
    return windows.filter(_off_grid(windows, size_seconds))


def failing_windows(windows: DataFrame, size_seconds: int = 3600, n: int = 5) -> DataFrame:
    """The first misaligned windows, as examples for a failed check."""
    return first_rows(misaligned(windows, size_seconds), n, "window_start")


def _alignment(windows: DataFrame, size_seconds: int) -> list[Check]:
    off = F.count_if(_off_grid(windows, size_seconds))
    return [(f"window_start on the {size_seconds} s grid", off)]


def _duration(windows: DataFrame, size_seconds: int) -> list[Check]:
    length = _seconds(windows, "window_end") - _seconds(windows, "window_start")
    off = F.count_if(length != size_seconds)
    return [(f"window length is {size_seconds} s", off)]


def _sanity(measures: Sequence[str], count: str) -> list[Check]:
    negative = F.lit(False)
    for name in measures:
        negative = negative | (F.col(name) < 0)
    empty = F.when(F.count("*") > 0, F.lit(0)).otherwise(1).cast("bigint")
    return [
        ("output has rows", empty),
        ("no null window_start", F.count_if(F.col("window_start").isNull())),
        ("no negative sums", F.count_if(negative)),
        ("every window has a record", F.count_if(F.col(count) < 1)),
    ]


def window_alignment_checks(windows: DataFrame, size_seconds: int = 3600) -> DataFrame:
    """Every window starts at a multiple of its size."""
    return _report(windows, _alignment(windows, size_seconds))


def window_duration_checks(windows: DataFrame, size_seconds: int = 3600) -> DataFrame:
    """Every window is exactly as long as it should be."""
    return _report(windows, _duration(windows, size_seconds))


def window_sanity_checks(
    windows: DataFrame, measures: Sequence[str] = (), count: str = "records"
) -> DataFrame:
    """Not empty, no window without a start, no negative sum, no window without a record."""
    return _report(windows, _sanity(measures, count))


def window_checks(
    windows: DataFrame,
    measures: Sequence[str] = (),
    count: str = "records",
    size_seconds: int = 3600,
) -> DataFrame:
    """All checks of a window table in one pass over it."""
    return _report(
        windows,
        [
            *_alignment(windows, size_seconds),
            *_duration(windows, size_seconds),
            *_sanity(measures, count),
        ],
    )


def years_in_scope_check(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    outside = F.count_if(~F.coalesce(F.col(year).between(first, last), F.lit(False)))
    return _report(df, [(f"years within {first}-{last}", outside)])


def readback_check(df: DataFrame, rows_written: int) -> DataFrame:
    """The stored table holds as many rows as were written."""
    return rows_read_check(df.agg(F.count("*").alias("rows_read")), rows_written)


def rows_read_check(counted: DataFrame, rows_written: int) -> DataFrame:
    """The same where the rows are counted already, as ``rows_read`` of one row (``sources.stored_rows``)."""
    read, written = F.col("rows_read"), F.lit(rows_written).cast("bigint")
    return counted.select(
        F.lit("read-back row count equals rows written").alias("check"),
        (read == written).alias("passed"),
        F.abs(read - written).alias("n_bad"),
        F.concat(read, F.lit(" of "), written, F.lit(" rows")).alias("detail"),
    )


def overall(checks: DataFrame) -> DataFrame:
    """One row: did every check pass, and the list of those that did not. No check at all is no pass."""
    return checks.agg(
        (F.coalesce(F.bool_and("passed"), F.lit(False))).alias("all_passed"),
        F.count("*").alias("n_checks"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check")))), ", "
        ).alias("failed"),
    )

"""Roll-ups, previews and checks over stored tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally.registry.base import query
from chronotally.registry.tables import EVENT_SUMS, EVENTS_SQL, events, line_items, table

HOURS_SQL = f"""
{EVENTS_SQL},
hours as (
  select
    count(*) as records,
    cast(sum(k) as bigint) as k_total,
    cast(sum(error_k) as bigint) as error_k_total,
    time_bucket(interval '1 hour', ts) as window_start,
    time_bucket(interval '1 hour', ts) + interval '1 hour' as window_end
  from e group by 4
),
halves as (
  select
    count(*) as records,
    cast(sum(k) as bigint) as k_total,
    cast(sum(error_k) as bigint) as error_k_total,
    time_bucket(interval '30 minutes', ts) as window_start,
    time_bucket(interval '30 minutes', ts) + interval '30 minutes' as window_end
  from e group by 4
)"""


def hours(spark: SparkSession, folder: str, size: str = "1 hour") -> DataFrame:
    return op.tumbling_windows(events(spark, folder), "ts", EVENT_SUMS, size)


# --- windows --------------------------------------------------------------------------------


@query("hourly_windows", f"with {HOURS_SQL} select * from hours")
def hourly_windows(spark: SparkSession, folder: str) -> DataFrame:
    return op.tumbling_windows(events(spark, folder), "ts", EVENT_SUMS, ordered=True)


@query(
    "hourly_windows_null_as_zero",
    f"""with {HOURS_SQL}
    select records, coalesce(k_total, 0) as k_total, coalesce(error_k_total, 0) as error_k_total,
      window_start, window_end from hours""",
)
def hourly_windows_null_as_zero(spark: SparkSession, folder: str) -> DataFrame:
    return op.tumbling_windows(events(spark, folder), "ts", EVENT_SUMS, null_as_zero=True)


@query(
    "hourly_series_slice",
    f"""with {HOURS_SQL}
    select * from hours
    where window_start >= timestamp '2024-01-08' and window_start < timestamp '2024-01-15'""",
)
def hourly_series_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The slice is cut on the records, so the scan skips the rest of the table."""
    low, high = datetime(2024, 1, 8), datetime(2024, 1, 15)
    part = op.event_time_slice(events(spark, folder), "ts", low, high)
    return op.window_slice(op.tumbling_windows(part, "ts", EVENT_SUMS), low, high)


@query(
    "preview_first_windows",
    f"with {HOURS_SQL} select * from hours order by window_start limit 10",
)
def preview_first_windows(spark: SparkSession, folder: str) -> DataFrame:
    return op.first_rows(hours(spark, folder), 10, "window_start")


# --- calendar -------------------------------------------------------------------------------


@query(
    "calendar_features",
    """select event_id, ts, cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
      dayname(ts) as day_of_week, cast(ts as date) as date,
      cast(weekofyear(ts) as integer) as week_of_year
    from events""",
)
def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "event_id", "ts", F.year("ts").alias("year"), F.month("ts").alias("month")
    )
    return op.with_calendar(rows, "ts")


@query(
    "counts_by_date",
    "select cast(l_shipdate as date) as date, count(*) as crash_count from lineitem group by 1",
)
def counts_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_by_date(line_items(spark, folder), "l_shipdate")


@query(
    "counts_by_week",
    """select cast(date_trunc('week', l_shipdate) as date) as week_start, count(*) as crash_count
    from lineitem group by 1""",
)
def counts_by_week(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_by_week(line_items(spark, folder), "l_shipdate")


@query(
    "counts_by_month",
    """select cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month,
      count(*) as crash_count
    from lineitem group by 1, 2""",
)
def counts_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_by_month(line_items(spark, folder), "l_shipdate")


@query(
    "counts_by_month_and_category",
    """select cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month,
      l_returnflag, count(*) as crash_count
    from lineitem group by 1, 2, 3""",
)
def counts_by_month_and_category(spark: SparkSession, folder: str) -> DataFrame:
    return op.count_by_month_and(line_items(spark, folder), "l_returnflag", "l_shipdate")


@query(
    "measures_by_month",
    """select cast(year(l_shipdate) as integer) as year, cast(month(l_shipdate) as integer) as month,
      cast(sum(cast(floor(l_quantity) as bigint)) as bigint) as total_quantity,
      cast(sum(l_linenumber) as bigint) as total_lines,
      count(*) as crash_count
    from lineitem group by 1, 2""",
)
def measures_by_month(spark: SparkSession, folder: str) -> DataFrame:
    measures = {"total_quantity": "quantity", "total_lines": "l_linenumber"}
    return op.sums_by_month(line_items(spark, folder), measures, "l_shipdate")


@query(
    "monthly_series_labeled",
    """select cast(year(o_orderdate) as integer) as year,
      cast(month(o_orderdate) as integer) as month, count(*) as crash_count,
      strftime(o_orderdate, '%Y-%m') as period
    from orders group by 1, 2, 4""",
)
def monthly_series_labeled(spark: SparkSession, folder: str) -> DataFrame:
    return op.monthly_series(op.count_by_month(table(spark, folder, "orders"), "o_orderdate"))


@query(
    "rows_by_year",
    'select cast(year(o_orderdate) as integer) as year, count(*) as "count" from orders group by 1',
)
def rows_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return op.rows_by_year(table(spark, folder, "orders"), "o_orderdate")


@query("distinct_years", "select distinct cast(year(o_orderdate) as integer) as year from orders")
def distinct_years(spark: SparkSession, folder: str) -> DataFrame:
    return op.distinct_years(table(spark, folder, "orders"), "o_orderdate")


@query(
    "run_summary",
    """select min(l_shipdate) as first_event, max(l_shipdate) as last_event,
      count(*) as rows_processed from lineitem""",
)
def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return op.run_summary(line_items(spark, folder), "l_shipdate")


# --- categories -----------------------------------------------------------------------------


@query(
    "breakdown_by_category",
    "select l_returnflag, count(*) as crash_count from lineitem group by 1",
)
def breakdown_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return op.breakdown(line_items(spark, folder), "l_returnflag")


@query(
    "breakdown_by_line_status",
    "select l_linestatus, count(*) as crash_count from lineitem group by 1",
)
def breakdown_by_line_status(spark: SparkSession, folder: str) -> DataFrame:
    return op.breakdown(line_items(spark, folder), "l_linestatus")


@query(
    "breakdown_by_event_type",
    "select event_type, count(*) as crash_count from events group by 1",
)
def breakdown_by_event_type(spark: SparkSession, folder: str) -> DataFrame:
    return op.breakdown(table(spark, folder, "events"), "event_type")


# --- checks: hour windows pass, half-hour windows judged as hours fail ----------------------


def _both(spark: SparkSession, folder: str, check) -> DataFrame:
    def one(size: str) -> DataFrame:
        return check(hours(spark, folder, size)).withColumn("windows", F.lit(size))

    return one("1 hour").unionByName(one("30 minutes"))


def _check_sql(label: str, bad: str) -> str:
    """One check over both window tables."""
    return " union all ".join(
        f"""select '{label}' as "check", count(*) filter ({bad}) = 0 as passed,
        count(*) filter ({bad}) as n_bad, count(*) filter ({bad}) || ' of ' || count(*) || ' rows' as detail,
        '{size}' as windows from {source}"""
        for source, size in (("hours", "1 hour"), ("halves", "30 minutes"))
    )


_ALIGNED = _check_sql(
    "window_start on the 3600 s grid",
    "minute(window_start) <> 0 or second(window_start) <> 0",
)
_LENGTH = _check_sql(
    "window length is 3600 s",
    "epoch(window_end) - epoch(window_start) <> 3600",
)
_SANE = " union all ".join(
    [
        """select 'output has rows' as "check", count(*) > 0 as passed,
        cast(count(*) = 0 as bigint) as n_bad,
        cast(count(*) = 0 as bigint) || ' of ' || count(*) || ' rows' as detail, '1 hour' as windows from hours
        union all select 'output has rows', count(*) > 0, cast(count(*) = 0 as bigint),
        cast(count(*) = 0 as bigint) || ' of ' || count(*) || ' rows', '30 minutes' from halves""",
        _check_sql("no null window_start", "window_start is null"),
        _check_sql("no negative sums", "k_total < 0 or error_k_total < 0"),
        _check_sql("every window has a record", "records < 1"),
    ]
)


@query("check_window_alignment", f"with {HOURS_SQL} {_ALIGNED}")
def check_window_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return _both(spark, folder, op.window_alignment_checks)


@query(
    "check_failing_windows",
    f"""with {HOURS_SQL} select * from halves
    where minute(window_start) <> 0 or second(window_start) <> 0
    order by window_start limit 5""",
)
def check_failing_windows(spark: SparkSession, folder: str) -> DataFrame:
    return op.failing_windows(hours(spark, folder, "30 minutes"))


@query("check_window_duration", f"with {HOURS_SQL} {_LENGTH}")
def check_window_duration(spark: SparkSession, folder: str) -> DataFrame:
    return _both(spark, folder, op.window_duration_checks)


def _sanity(windows: DataFrame) -> DataFrame:
    return op.window_sanity_checks(windows, list(EVENT_SUMS))


@query("check_window_sanity", f"with {HOURS_SQL} {_SANE}")
def check_window_sanity(spark: SparkSession, folder: str) -> DataFrame:
    return _both(spark, folder, _sanity)


@query(
    "check_overall",
    f"""with {HOURS_SQL}, checks as ({_ALIGNED} union all {_LENGTH} union all {_SANE})
    select bool_and(passed) as all_passed, count(*) as n_checks,
      coalesce(string_agg("check", ', ' order by "check") filter (not passed), '') as failed
    from checks""",
)
def check_overall(spark: SparkSession, folder: str) -> DataFrame:
    def all_checks(windows: DataFrame) -> DataFrame:
        return op.window_checks(windows, list(EVENT_SUMS))

    return op.overall(_both(spark, folder, all_checks))

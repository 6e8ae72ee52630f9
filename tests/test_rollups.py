from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally import plans
from chronotally.session import settings
from chronotally.sources import read_output
from chronotally.spec import CRASH_ROLLUPS
from crash_rows import clean_frame

SUMS = CRASH_ROLLUPS.window_sums
ROWS = [
    (datetime(2022, 1, 5, 20, 0), 1, 0, "CLEAR"),
    (datetime(2022, 1, 5, 20, 59, 59), 2, 1, "RAIN"),
    (datetime(2022, 1, 5, 21, 0), None, None, "RAIN"),
    (datetime(2022, 1, 6, 0, 0), 4, 0, None),
    (datetime(2022, 3, 1, 12, 0), 0, 0, "CLEAR"),
]


@pytest.fixture()
def clean(spark):
    return clean_frame(spark, ROWS)


def values(df):
    return [tuple(r) for r in df.collect()]


def test_hour_windows(clean):
    df = op.tumbling_windows(clean, "CRASH_DATE", SUMS, ordered=True)
    assert df.dtypes == [
        ("records", "bigint"), ("injuries_total", "bigint"), ("injuries_fatal", "bigint"),
        ("window_start", "timestamp"), ("window_end", "timestamp"),
    ]
    hour = timedelta(hours=1)
    assert values(df) == [
        (n, total, fatal, t, t + hour)
        for n, total, fatal, t in [
            (2, 3, 1, datetime(2022, 1, 5, 20)),
            (1, None, None, datetime(2022, 1, 5, 21)),  # nothing but NULL sums to NULL
            (1, 4, 0, datetime(2022, 1, 6)),
            (1, 0, 0, datetime(2022, 3, 1, 12)),
        ]
    ]


def test_null_as_zero(clean):
    df = op.tumbling_windows(clean, "CRASH_DATE", SUMS, null_as_zero=True, ordered=True)
    assert [r.injuries_total for r in df.collect()] == [3, 0, 4, 0]
    months = op.sums_by_month(
        clean.filter("INJURIES_TOTAL is null"), CRASH_ROLLUPS.month_sums, null_as_zero=True
    )
    assert values(months) == [(2022, 1, 0, 0, 1)]


def test_a_record_without_time_is_in_no_window_but_in_its_groups(spark):
    df = clean_frame(spark, [*ROWS, (None, 9, 9, "FOG")])
    assert op.tumbling_windows(df, "CRASH_DATE", SUMS).agg(F.sum("records")).first()[0] == len(ROWS)
    assert op.count_by_date(df, "CRASH_DATE").first() == (None, 1)
    assert ("FOG", 1) in values(op.breakdown(df, "WEATHER_CONDITION"))


def test_dates_months_years(clean):
    assert values(op.count_by_date(clean, "CRASH_DATE")) == [
        (date(2022, 1, 5), 3), (date(2022, 1, 6), 1), (date(2022, 3, 1), 1),
    ]
    assert values(op.count_by_month(clean)) == [(2022, 1, 4), (2022, 3, 1)]  # no row for February
    assert values(op.sums_by_month(clean, CRASH_ROLLUPS.month_sums)) == [
        (2022, 1, 7, 1, 4), (2022, 3, 0, 0, 1),
    ]
    assert values(op.rows_by_year(clean)) == [(2022, 5)]
    assert values(op.distinct_years(clean)) == [(2022,)]
    assert [r.period for r in op.monthly_series(op.count_by_month(clean)).collect()] == [
        "2022-01", "2022-03",
    ]


def test_weeks_do_not_mix_years(spark):
    days = [datetime(2022, 1, 1), datetime(2022, 12, 31), datetime(2021, 12, 27)]
    df = clean_frame(spark, [(d, 0, 0, "X") for d in days])
    assert values(op.count_by_week(df, "CRASH_DATE")) == [
        (date(2021, 12, 27), 2), (date(2022, 12, 26), 1),
    ]


def test_breakdown_order_and_ties(clean):
    assert values(op.breakdown(clean, "WEATHER_CONDITION")) == [
        ("CLEAR", 2), ("RAIN", 2), (None, 1),
    ]


def test_category_over_months(clean):
    assert values(op.count_by_month_and(clean, "PRIM_CONTRIBUTORY_CAUSE")) == [
        (2022, 1, "SPEED", 4), (2022, 3, "SPEED", 1),
    ]


def test_calendar_frame(clean):
    row = op.with_calendar(clean, "CRASH_DATE").filter("CRASH_RECORD_ID = 'r0'").first()
    assert (row.day_of_week, row.date, row.week_of_year) == ("Wednesday", date(2022, 1, 5), 1)


def test_event_time_must_be_named_without_partition_columns(clean):
    with pytest.raises(ValueError, match="event time"):
        op.count_by_month(clean.drop("year", "month"))
    assert values(op.count_by_month(clean.drop("year", "month"), "CRASH_DATE")) == [
        (2022, 1, 4), (2022, 3, 1),
    ]


def test_summary_and_preview(clean):
    row = op.run_summary(clean, "CRASH_DATE", 1.5, CRASH_ROLLUPS.outputs()).first()
    assert tuple(row) == (ROWS[0][0], ROWS[-1][0], 5, CRASH_ROLLUPS.outputs(), 1.5)
    windows = op.tumbling_windows(clean, "CRASH_DATE", SUMS)
    first = op.first_rows(windows, 2, "window_start")
    assert [r.records for r in first.collect()] == [2, 1]
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
    part = op.window_slice(windows, datetime(2022, 1, 5, 21), datetime(2022, 3, 1, 12))
    assert [r.window_start for r in part.collect()] == [
        datetime(2022, 1, 5, 21), datetime(2022, 1, 6),
    ]


def test_zones(spark):
    """Windows stay on the UTC grid; dates and weeks follow the session zone."""
    rows = [(datetime(2022, 11, 6, 6, 30), 1, 0, "X"), (datetime(2022, 11, 6, 7, 30), 1, 0, "X")]
    path_df = clean_frame(spark, rows).select("CRASH_DATE", *set(SUMS.values()))
    with settings(spark, {"spark.sql.session.timeZone": "America/Chicago"}):
        windows = op.tumbling_windows(path_df, "CRASH_DATE", SUMS, ordered=True)
        printed = windows.select(F.date_format("window_start", "HH:mm")).collect()
        assert [r[0] for r in printed] == ["01:00", "01:00"]  # the hour that happens twice
        assert windows.count() == 2
        assert op.window_alignment_checks(windows).first().passed
    with settings(spark, {"spark.sql.session.timeZone": "Asia/Kolkata"}):
        windows = op.tumbling_windows(path_df, "CRASH_DATE", SUMS)
        minutes = windows.select(F.minute("window_start")).distinct().collect()
        assert [r[0] for r in minutes] == [30]
        assert op.window_alignment_checks(windows).first().passed


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_outputs_by_time_follow_from_one_scan(spark, tmp_path, zone):
    late = datetime(2022, 1, 5, 18, 45)  # its hour touches two dates in a half-hour zone
    early = datetime(2022, 1, 5, 18, 15)
    rows = [*ROWS, (late, 1, 1, "X"), (early, 2, 0, "X"), (None, 9, 9, "FOG"), (None, None, None, None)]
    clean_frame(spark, rows).write.parquet(str(tmp_path / "t"))
    with settings(spark, {"spark.sql.session.timeZone": zone}):
        df = spark.read.parquet(str(tmp_path / "t"))
        base = plans.time_rollup(df, CRASH_ROLLUPS)
        plan = base._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 1
        read = plan.split("ReadSchema: ")[1]
        assert "CRASH_DATE" in read and "WEATHER" not in read
        got = {**plans.outputs_by_time(base, CRASH_ROLLUPS), **plans.outputs_by_category(df, CRASH_ROLLUPS)}
        want = {
            "crashes_by_hour_window": op.tumbling_windows(df, "CRASH_DATE", SUMS, count="crashes", ordered=True),
            "crashes_by_date": op.count_by_date(df, "CRASH_DATE"),
            "crashes_by_month": op.count_by_month(df),
            "injuries_by_month": op.sums_by_month(df, CRASH_ROLLUPS.month_sums),
            **{out: op.breakdown(df, c) for out, c in CRASH_ROLLUPS.categories.items()},
        }
        assert list(got) == list(want) == CRASH_ROLLUPS.outputs()
        for name in want:
            assert got[name].dtypes == want[name].dtypes
            assert values(got[name]) == values(want[name]), name


def test_write_gold(spark, clean, tmp_path):
    root = str(tmp_path / "gold")
    run = plans.write_gold(clean, CRASH_ROLLUPS, root)
    assert run.outputs == CRASH_ROLLUPS.outputs() and run.elapsed_seconds > 0
    plans.write_gold(clean, CRASH_ROLLUPS, root)  # again: replaced, not doubled
    windows = read_output(spark, f"{root}/crashes_by_hour_window")
    assert values(windows.orderBy("window_start")) == values(
        op.tumbling_windows(clean, "CRASH_DATE", SUMS, ordered=True)
    )
    months = read_output(spark, f"{root}/injuries_by_month").orderBy("month")
    assert values(months) == [(2022, 1, 7, 1, 4), (2022, 3, 0, 0, 1)]
    weather = values(read_output(spark, f"{root}/crashes_by_weather"))
    assert weather == [("CLEAR", 2), ("RAIN", 2), (None, 1)]


def test_a_hot_group_is_aggregated_before_the_shuffle(spark):
    """A third and more of the rows in one hour: each task sends one row for it."""
    df = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.lit(datetime(2022, 1, 1)))
        .otherwise(F.timestamp_seconds(F.lit(1640995200) + F.col("id")))
        .alias("CRASH_DATE"),
        F.lit(1).alias("INJURIES_TOTAL"),
        F.lit(0).alias("INJURIES_FATAL"),
    )
    windows = op.tumbling_windows(df, "CRASH_DATE", SUMS)
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning(window")
    rows = {r.window_start: r.records for r in windows.collect()}
    assert sum(rows.values()) == 90_000 and rows[datetime(2022, 1, 1)] == 60_000 + 1200


def test_kept_is_released(spark, clean):
    with op.kept(clean) as shared:
        assert shared.storageLevel.useMemory
        assert op.rows_by_year(shared).first()[1] == 5
    assert not clean.storageLevel.useMemory
    with op.kept(clean, outputs=1) as single:
        assert not single.storageLevel.useMemory


record = st.tuples(
    st.datetimes(datetime(2022, 1, 1), datetime(2025, 12, 31)).map(lambda t: t.replace(microsecond=0)),
    st.none() | st.integers(0, 9),
    st.none() | st.integers(0, 2),
    st.sampled_from(["CLEAR", "RAIN", None]),
)


@limits(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(record, min_size=1, max_size=40))
def test_totals_agree_between_roll_ups(spark, rows):
    df = clean_frame(spark, rows).coalesce(2)
    windows = op.tumbling_windows(df, "CRASH_DATE", SUMS)
    by_day = windows.groupBy(F.to_date("window_start").alias("date")).agg(F.sum("records").alias("n"))
    days = values(op.count_by_date(df, "CRASH_DATE"))
    assert values(by_day.orderBy("date")) == days
    assert sum(n for _, n in days) == len(rows)
    months = values(op.count_by_month(df))
    for year, month, n in months:
        assert n == sum(m for d, m in days if (d.year, d.month) == (year, month))
    assert op.window_sanity_checks(windows).filter("not passed").isEmpty()


def test_records_without_a_time_are_in_no_year(spark):
    df = clean_frame(spark, [*ROWS, (None, 1, 0, "X")])
    assert op.years_between(df, 2022, 2025).count() == len(ROWS)

"""Counts and extremes from footers, ragged rows, and months cleaned again."""

import glob
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally import plans
from chronotally.sources import (
    footer_reader,
    read_bronze,
    read_cleaned,
    stored_extremes,
    stored_rows,
    stored_rows_by,
    stored_summary,
)
from chronotally.spec import CRASH_RECORDS
from crash_rows import COLUMNS, clean_frame, raw, write_raw

SCHEMA = CRASH_RECORDS.schema()


def crashes(spark):
    times = [datetime(2022, 1, 5, 3), datetime(2022, 1, 1), datetime(2023, 6, 1), datetime(2025, 12, 31, 23, 59, 59)]
    return clean_frame(spark, [(t, i, 0, "CLEAR") for i, t in enumerate(times)])


@pytest.fixture()
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    crashes(spark).write.partitionBy("year", "month").parquet(path)
    return path


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_counts_are_pushed_to_the_footers(spark, table):
    counted = stored_rows(spark, table, SCHEMA)
    assert "PushedAggregation: [COUNT(*)]" in plan_of(counted)
    assert counted.first().rows_read == 4
    by_month = stored_rows_by(spark, table, ["year", "month"], "n", SCHEMA)
    assert "PushedGroupBy: [year, month]" in plan_of(by_month)
    assert {tuple(r) for r in by_month.collect()} == {(2022, 1, 2), (2023, 6, 1), (2025, 12, 1)}
    assert op.rows_read_check(counted, 4).first().passed and not op.rows_read_check(counted, 5).first().passed


def test_the_callers_session_is_left_as_it_was(spark, table):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert footer_reader(spark, table).count() == 4
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_summary_reads_only_the_first_and_the_last_month(spark, table):
    summary = stored_summary(spark, table, "CRASH_DATE", SCHEMA)
    assert summary.first() == op.run_summary(crashes(spark), "CRASH_DATE").first()
    plan = plan_of(summary)
    assert "ReadSchema: struct<CRASH_DATE:timestamp>" in plan
    months = [2022 * 12 + 1, 2025 * 12 + 12]
    assert "PartitionFilters: [((year#" in plan and all(str(m) in plan for m in months)


def test_summary_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty")
    crashes(spark).limit(0).write.parquet(path)
    assert tuple(stored_summary(spark, path, "CRASH_DATE", SCHEMA).first()) == (None, None, 0)


def test_extremes(spark, tmp_path):
    path = str(tmp_path / "numbers")
    rows = [(1, 2.5, date(2024, 1, 2), "b"), (None, -1.0, None, "a"), (7, None, date(2020, 1, 1), "c")]
    spark.createDataFrame(rows, "i int, d double, t date, s string").coalesce(1).write.parquet(path)
    assert "PushedAggregation: [MIN(i)" in plan_of(footer_reader(spark, path).agg(F.min("i"), F.max("d"), F.count("t")))
    assert {tuple(r) for r in stored_extremes(spark, path, ["i", "d", "t"]).collect()} == {
        ("i", "1", "7", 2), ("d", "-1.0", "2.5", 2), ("t", "2020-01-01", "2024-01-02", 2)
    }
    with pytest.raises(ValueError, match="'s'"):
        stored_extremes(spark, path, ["s"])


def test_extremes_where_a_file_has_none(spark, tmp_path):
    """A file without a single value has no extremes in its footer: the column is read instead."""
    path = str(tmp_path / "gaps")
    for rows in ([(1, None)], [(None, None)], [(5, None)]):
        spark.createDataFrame(rows, "i int, j int").coalesce(1).write.mode("append").parquet(path)
    assert {tuple(r) for r in stored_extremes(spark, path, ["i", "j"]).collect()} == {("i", "1", "5", 2), ("j", None, None, 0)}


# --- ragged rows ----------------------------------------------------------------------------


@pytest.mark.parametrize("multi_line", [True, False, None])
def test_ragged_rows_are_marked(spark, tmp_path, multi_line):
    path = tmp_path / "ragged.csv"
    path.write_text('a,b,c\n1,2\n3,4,5,6\n7,8,9\n,,\n"x,y",2,3\n')
    rows = read_bronze(spark, str(path), ["a", "b", "c"], multi_line, ragged="odd").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "2", None, "1,2"), ("3", "4", "5", "3,4,5,6"), ("7", "8", "9", None), (None, None, None, None), ("x,y", "2", "3", None)
    ]
    with pytest.raises(ValueError, match="columns"):
        read_bronze(spark, str(path), ragged="odd")


def test_ragged_rows_are_counted(spark, tmp_path):
    rows = [raw("whole"), raw("short")[:-1], [*raw("long"), "more"], raw("bad time", "")[:-2], raw("early", "12/31/2021 12:00:00 AM")]
    path = write_raw(tmp_path / "raw.csv", rows, extra=False)
    df = read_bronze(spark, path, COLUMNS, multi_line=False, ragged="odd")
    counts = plans.write_clean(df, CRASH_RECORDS, str(tmp_path / "clean"), ragged="odd")
    assert counts == plans.CleanCounts(5, 1, 1, 3, ragged=3)
    stored = read_cleaned(spark, str(tmp_path / "clean"))
    assert stored.schema == SCHEMA
    assert {r.CRASH_RECORD_ID for r in stored.collect()} == {"whole", "short", "long"}
    plain = read_bronze(spark, path, COLUMNS, multi_line=False)
    assert plans.write_clean(plain, CRASH_RECORDS, str(tmp_path / "clean")).ragged is None


# --- months cleaned again -------------------------------------------------------------------


def files(path):
    return {(os.path.relpath(f, path), os.stat(f).st_mtime_ns) for f in glob.glob(f"{path}/year=*/**/*.parquet", recursive=True)}


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_other_months_are_left_alone(spark, tmp_path, mode):
    path = str(tmp_path / "clean")
    rows = [raw("jan", "01/05/2022 08:30:00 PM"), raw("feb", "02/05/2022 08:30:00 PM"), raw("mar", "03/05/2022 08:30:00 PM")]
    plans.write_clean(read_bronze(spark, write_raw(tmp_path / "a.csv", rows)), CRASH_RECORDS, path)
    before = files(path)
    again = read_bronze(spark, write_raw(tmp_path / "b.csv", [raw("jan too"), raw("feb again", "02/01/2022 01:00:00 AM"), raw("bad", "")]))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        counts = plans.reclean_months(again, CRASH_RECORDS, path, [(2022, 2), (2022, 3)])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert counts == plans.CleanCounts(3, 1, 1, 1)
    assert {r.CRASH_RECORD_ID for r in read_cleaned(spark, path, SCHEMA).collect()} == {"jan", "feb again"}
    assert {f for f in before if "month=1" in f[0]} < files(path)
    assert not {f for f in files(path) if "month=3" in f[0]}
    with pytest.raises(ValueError, match="no months"):
        plans.reclean_months(again, CRASH_RECORDS, path, [])


def test_a_month_that_was_not_there(spark, tmp_path):
    path = str(tmp_path / "clean")
    plans.write_clean(read_bronze(spark, write_raw(tmp_path / "a.csv", [raw("jan")])), CRASH_RECORDS, path)
    more = read_bronze(spark, write_raw(tmp_path / "b.csv", [raw("dec", "12/05/2023 08:30:00 PM")]))
    plans.reclean_months(more, CRASH_RECORDS, path, [(2023, 12), (2024, 1)])
    assert {r.CRASH_RECORD_ID for r in read_cleaned(spark, path, SCHEMA).collect()} == {"jan", "dec"}


def test_several_outputs_share_one_frame(spark, tmp_path):
    evaluated = spark.sparkContext.accumulator(0)

    def seen(x):
        evaluated.add(1)
        return x

    df = crashes(spark).withColumn("INJURIES_TOTAL", F.udf(seen, "int")("INJURIES_TOTAL"))
    outputs = {
        "by_day": lambda rows: rows.groupBy("day_of_week").agg(F.sum("INJURIES_TOTAL").alias("n")),
        "by_week": lambda rows: rows.groupBy("week_of_year").agg(F.sum("INJURIES_TOTAL").alias("n")),
    }
    assert plans.write_analysis(df, "CRASH_DATE", outputs, str(tmp_path)) == ["by_day", "by_week"]
    assert evaluated.value == 4
    assert spark.read.parquet(f"{tmp_path}/by_week").agg(F.sum("n")).first()[0] == 6

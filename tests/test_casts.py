from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronotally.functions import (
    iso_week,
    lenient_int,
    parse_time,
    period_label,
    week_start,
    weekday_name,
)
from chronotally.session import settings

PATTERN = "MM/dd/yyyy hh:mm:ss a"


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r.out for r in df.select(expression.alias("out")).collect()]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_int_is_the_old_text_cast(spark, ansi):
    cases = {
        "1": 1, " 3 ": 3, "1.5": 1, "-1.9": -1, "+7": 7, "1.": 1, ".5": 0, "-.5": 0, "\t8\n": 8,
        "2.0 ": 2, "": None, " ": None, "abc": None, "1e3": None, "1.2.3": None, "1d": None,
        "99999999999": None, "2147483647": 2147483647, "2147483648": None, "NaN": None, None: None,
        "1 2": None, "1.5x": None, "- 1": None, "-2147483648": -2147483648,
    }
    with settings(spark, {"spark.sql.ansi.enabled": ansi}):
        got = column(spark, list(cases), lenient_int(F.col("v")))
    assert dict(zip(cases, got)) == cases


def test_lenient_int_agrees_with_the_non_ansi_cast(spark):
    texts = [
        "0", "-0", "00012", "+", "-", ".", "+.", "1,5", "1_0", "１", "0x1F", "1.5e2", "1.", " .7 ",
        "--1", "9.99999999999999999", "2147483647.9", "-2147483649", "1 .5", "\x00 4", "4\x7f",
    ]
    with settings(spark, {"spark.sql.ansi.enabled": "false"}):
        want = column(spark, texts, F.col("v").cast("int"))
    assert column(spark, texts, lenient_int(F.col("v"))) == want


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parse_time(spark, ansi):
    cases = {
        "01/05/2022 08:30:00 PM": datetime(2022, 1, 5, 20, 30),
        "01/05/2022 08:30:00 pm": datetime(2022, 1, 5, 20, 30),
        "01/01/2022 12:00:00 AM": datetime(2022, 1, 1),
        "01/01/2022 12:00:00 PM": datetime(2022, 1, 1, 12),
        "1/5/2022 8:30:00 PM": None, "02/30/2022 01:00:00 AM": None,
        "13/05/2022 08:30:00 PM": None, "01/05/2022 20:30:00": None, "2022-01-05": None,
        "": None, None: None,
    }
    with settings(spark, {"spark.sql.ansi.enabled": ansi}):
        got = column(spark, list(cases), parse_time(F.col("v"), PATTERN))
    assert dict(zip(cases, got)) == cases


def test_spring_forward_hour_moves_on(spark):
    text = ["03/13/2022 02:30:00 AM"]
    with settings(spark, {"spark.sql.session.timeZone": "America/Chicago"}):
        epoch = column(spark, text, F.unix_timestamp(parse_time(F.col("v"), PATTERN)))
    assert epoch == [1647160200]  # 08:30 UTC, 03:30 on the clock


def test_calendar(spark):
    days = [datetime(2022, 1, 1), datetime(2024, 12, 30, 23, 59), datetime(2023, 5, 7)]
    assert column(spark, days, weekday_name(F.col("v")), "timestamp") == [
        "Saturday", "Monday", "Sunday",
    ]
    assert column(spark, days, iso_week(F.col("v")), "timestamp") == [52, 1, 18]
    assert column(spark, days, week_start(F.col("v")), "timestamp") == [
        date(2021, 12, 27), date(2024, 12, 30), date(2023, 5, 1),
    ]


def test_period_label(spark):
    df = spark.createDataFrame([(2022, 3), (2025, 12)], "year int, month int")
    labels = df.select(period_label(F.col("year"), F.col("month"))).collect()
    assert [r[0] for r in labels] == ["2022-03", "2025-12"]

import glob
import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally import plans
from chronotally.session import settings
from chronotally.sinks import write_partitioned, write_table
from chronotally.sources import lines_are_records, read_bronze, read_cleaned, schema_of
from chronotally.spec import CRASH_RECORDS
from crash_rows import BAD_TIMES, CLEAN, COLUMNS, RAW_ROWS, raw, write_raw


def test_scan_is_text_and_keeps_quoted_breaks(spark, tmp_path):
    df = read_bronze(spark, write_raw(tmp_path / "raw.csv"))
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.columns == [*COLUMNS, "STREET_NAME"]
    rows = {r.CRASH_RECORD_ID: r for r in df.collect()}
    assert len(rows) == len(RAW_ROWS)
    assert rows["quoting"].PRIM_CONTRIBUTORY_CAUSE == 'FAILED, "YIELD"\nTO RIGHT'
    assert rows["empty_int"].INJURIES_TOTAL is None


def test_short_and_long_rows(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text("a,b,c\n1,2\n3,4,5,6\n")
    for multi_line in (None, True, False):
        rows = read_bronze(spark, str(path), multi_line=multi_line).collect()
        assert [tuple(r) for r in rows] == [("1", "2", None), ("3", "4", "5")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_given_columns_are_those_of_the_header(spark, tmp_path, multi_line):
    path = tmp_path / "b_a.csv"
    path.write_text("b,a\nB1,A1\n")
    rows = read_bronze(spark, str(path), ["b", "a"], multi_line).collect()
    assert [r.asDict() for r in rows] == [{"b": "B1", "a": "A1"}]
    for wrong in (["a", "b"], ["b", "c"], ["b"]):
        with pytest.raises(Exception, match="header"):
            read_bronze(spark, str(path), wrong, multi_line).collect()


def test_missing_column_is_refused_by_name(spark, tmp_path):
    path = write_raw(tmp_path / "raw.csv", header=["OTHER" if c == "CRASH_DATE" else c for c in COLUMNS])
    with pytest.raises(ValueError, match="CRASH_DATE"):
        plans.clean(read_bronze(spark, path), CRASH_RECORDS)


def test_clean(spark, tmp_path):
    df = plans.clean(read_bronze(spark, write_raw(tmp_path / "raw.csv")), CRASH_RECORDS)
    assert df.schema == CRASH_RECORDS.schema()
    assert {r.CRASH_RECORD_ID: (r.CRASH_DATE, r.INJURIES_TOTAL) for r in df.collect()} == CLEAN


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_write_clean_counts_and_reads_back(spark, tmp_path, adaptive):
    raw_df = read_bronze(spark, write_raw(tmp_path / "raw.csv"))
    path = str(tmp_path / "clean")
    with settings(spark, {"spark.sql.adaptive.enabled": adaptive}):
        counts = plans.write_clean(raw_df, CRASH_RECORDS, path)
        again = plans.write_clean(raw_df, CRASH_RECORDS, path)  # overwrite: same result
    assert counts == again == plans.CleanCounts(len(RAW_ROWS), len(BAD_TIMES), 2, len(CLEAN))
    stored = read_cleaned(spark, path)
    assert stored.schema == CRASH_RECORDS.schema() == schema_of(spark, path)
    assert {r.CRASH_RECORD_ID: (r.CRASH_DATE, r.INJURIES_TOTAL) for r in stored.collect()} == CLEAN
    folders = {d for d in os.listdir(tmp_path / "clean") if d.startswith("year")}
    assert folders == {"year=2022", "year=2025"}
    assert op.readback_check(stored, counts.rows_out).first().passed
    assert not op.readback_check(stored, counts.rows_out + 1).first().passed


def test_nothing_kept(spark, tmp_path):
    raw_df = read_bronze(spark, write_raw(tmp_path / "raw.csv", [raw("x", "nope")]))
    counts = plans.write_clean(raw_df, CRASH_RECORDS, str(tmp_path / "clean"))
    assert counts == plans.CleanCounts(1, 1, 0, 0)
    assert read_cleaned(spark, str(tmp_path / "clean"), CRASH_RECORDS.schema()).count() == 0


def test_save_modes(spark, tmp_path):
    df = spark.range(3).withColumn("k", F.lit(1))
    path = str(tmp_path / "t")
    write_table(df, path, "errorifexists")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_table(df, path, "errorifexists")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_partitioned(df, path, ["k"], mode="errorifexists")
    with pytest.raises(ValueError, match="mode"):
        write_table(df, path, "ignore")


def test_hot_month_is_cut_and_counted_once(spark, tmp_path):
    """Two thirds of the rows in one month, a quarter unreadable: more than one task writes the
    month, small months get one file each, and the counts are right."""
    n = 60_000
    text = (
        F.when(F.col("id") % 4 == 0, "unreadable")
        .when(F.col("id") % 97 == 1, "03/05/2023 01:00:00 AM")
        .when(F.col("id") % 97 == 2, "04/05/2019 01:00:00 AM")
        .otherwise("01/05/2022 08:30:00 PM")
    )
    filler = F.sha2(F.col("id").cast("string"), 512)
    raw_df = spark.range(0, n, 1, 8).select(
        F.col("id").cast("string").alias("CRASH_RECORD_ID"),
        text.alias("CRASH_DATE"),
        *[F.lit("1").alias(c) for c in ("INJURIES_TOTAL", "INJURIES_FATAL")],
        *[filler.alias(c) for c in COLUMNS[4:]],
    )
    path = str(tmp_path / "clean")
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}):
        counts = plans.write_clean(raw_df, CRASH_RECORDS, path)
    ids = range(n)
    bad = sum(i % 4 == 0 for i in ids)
    old = sum(i % 4 != 0 and i % 97 == 2 for i in ids)
    assert counts == plans.CleanCounts(n, bad, old, n - bad - old)
    assert read_cleaned(spark, path).select("CRASH_RECORD_ID").distinct().count() == counts.rows_out
    hot = glob.glob(f"{path}/year=2022/month=1/*.parquet")
    small = glob.glob(f"{path}/year=2023/month=3/*.parquet")
    assert len(hot) > 4 and len(small) <= 2


def test_time_slice_prunes_folders_and_row_groups(spark, tmp_path):
    raw_df = read_bronze(spark, write_raw(tmp_path / "raw.csv"))
    path = str(tmp_path / "clean")
    plans.write_clean(raw_df, CRASH_RECORDS, path)
    low, high = datetime(2022, 1, 5), datetime(2022, 1, 6)
    part = op.event_time_slice(read_cleaned(spark, path), "CRASH_DATE", low, high)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThanOrEqual(CRASH_DATE" in plan and "LessThan(CRASH_DATE" in plan
    want = {k for k, (t, _) in CLEAN.items() if low <= t < high}
    assert {r.CRASH_RECORD_ID for r in part.collect()} == want


def test_year_filter_lists_only_its_folders(spark, tmp_path):
    path = str(tmp_path / "clean")
    plans.write_clean(read_bronze(spark, write_raw(tmp_path / "raw.csv")), CRASH_RECORDS, path)
    df = op.years_between(read_cleaned(spark, path, CRASH_RECORDS.schema()), 2025, 2025)
    assert df.count() == 1
    assert "(year#" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1]


def last_plan(spark):
    """Physical plan of the latest finished query, as Spark recorded it."""
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    return runs.apply(runs.size() - 1).physicalPlanDescription()


@pytest.mark.parametrize("time_order", [False, True])
def test_one_shuffle_and_one_sort_per_write(spark, tmp_path, time_order):
    """The order asked for serves the writer too: it does not sort a second time."""
    raw_df = read_bronze(spark, write_raw(tmp_path / "raw.csv"))
    plans.write_clean(raw_df, CRASH_RECORDS, str(tmp_path / "clean"), time_order=time_order)
    final = last_plan(spark).split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    tree = final.split("\n\n(")[0]
    assert tree.count("Sort (") == 1 and tree.count("Exchange (") == 1
    assert tree.index("CollectMetrics") < tree.index("Exchange (")


@pytest.mark.parametrize(
    "text, by_line",
    [
        ("a,b\n1,2\n", True),
        ('a,b\n"x, ""y""",2\n', True),
        ('a,b\r\n"1",2\r\n\r\n3,4\r\n', True),
        ("", True),
        ('a,b\n"x\ny",2\n', False),
        ('a,b\n1,5" pipe\n', False),
        ('a,b\n5" x,"y\nz",1\n', False),
        ("a,b\n  \n1,2\n", False),
        ("a,b\n1,2\r\n3,4\n", False),
        ("a,b\n1\r2,3\n", False),
    ],
)
def test_lines_are_records(spark, tmp_path, text, by_line):
    path = tmp_path / "f.csv"
    path.write_bytes(text.encode())
    assert lines_are_records(spark, str(path)) is by_line
    if not text:
        return
    auto = [tuple(r) for r in read_bronze(spark, str(path), multi_line=None).collect()]
    whole = read_bronze(spark, str(path))
    assert auto == [tuple(r) for r in whole.collect()]

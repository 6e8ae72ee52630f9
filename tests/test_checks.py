from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally.sources import read_output_or_none, table_status

HOUR = timedelta(hours=1)
T = datetime(2022, 1, 5, 20)
GOOD = [(3, 2, 0, T, T + HOUR), (1, None, None, T + HOUR, T + 2 * HOUR)]
SCHEMA = (
    "records bigint, injuries_total bigint, injuries_fatal bigint, "
    "window_start {0}, window_end {0}"
)

MEASURES = ("injuries_total", "injuries_fatal")


def windows(spark, rows, kind="timestamp"):
    return spark.createDataFrame(rows, SCHEMA.format(kind))


def report(df):
    return {r.check: (r.passed, r.n_bad, r.detail) for r in df.collect()}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_good_windows_pass(spark, kind):
    df = windows(spark, GOOD, kind)
    checks = op.window_checks(df, measures=MEASURES)
    assert checks.columns == ["check", "passed", "n_bad", "detail"]
    assert tuple(op.overall(checks).first()) == (True, 6, "")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_alignment_fails(spark, kind):
    half = T + timedelta(minutes=30)
    second = T + timedelta(seconds=5)
    df = windows(spark, [*GOOD, (1, 0, 0, half, half + HOUR), (1, 0, 0, second, second + HOUR)], kind)
    assert report(op.window_alignment_checks(df)) == {
        "window_start on the 3600 s grid": (False, 2, "2 of 4 rows")
    }
    assert [r.window_start for r in op.failing_windows(df, n=1).collect()] == [second]
    assert op.misaligned(df).count() == 2
    # the same windows are fine on a half-hour grid, but for the stray five seconds
    assert report(op.window_alignment_checks(df, 1800))["window_start on the 1800 s grid"][1] == 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_duration_fails(spark, kind):
    df = windows(spark, [*GOOD, (1, 0, 0, T, T + 2 * HOUR)], kind)
    assert report(op.window_duration_checks(df)) == {
        "window length is 3600 s": (False, 1, "1 of 3 rows")
    }
    assert report(op.window_duration_checks(df, 7200))["window length is 7200 s"][1] == 2


def test_sanity_fails_one_by_one(spark):
    bad = {
        "no null window_start": (1, 0, 0, None, None),
        "no negative sums": (1, -1, None, T, T + HOUR),
        "every window has a record": (0, 0, 0, T, T + HOUR),
    }
    for check, row in bad.items():
        checks = op.window_sanity_checks(windows(spark, [*GOOD, row]), measures=MEASURES)
        assert {name for name, (passed, *_ ) in report(checks).items() if not passed} == {check}
        assert op.overall(checks).first().failed == check


def test_empty_output_fails(spark):
    checks = report(op.window_sanity_checks(windows(spark, []), measures=MEASURES))
    assert checks["output has rows"] == (False, 1, "1 of 0 rows")
    assert checks["no negative sums"] == (True, 0, "0 of 0 rows")


def test_no_checks_are_no_pass(spark):
    none = op.window_checks(windows(spark, GOOD), measures=MEASURES).limit(0)
    assert tuple(op.overall(none).first()) == (False, 0, "")


def test_all_checks_take_one_pass(spark, tmp_path):
    windows(spark, GOOD).write.parquet(str(tmp_path / "w"))
    checks = op.window_checks(spark.read.parquet(str(tmp_path / "w")))
    assert checks.count() == 6
    assert checks._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_years_in_scope(spark):
    df = spark.createDataFrame([(2022,), (2025,), (2021,), (None,)], "year int")
    assert op.years_in_scope_check(df, 2022, 2025).first().n_bad == 2
    assert op.years_in_scope_check(df.filter("year >= 2022"), 2022, 2025).first().passed


def test_columns_required(spark):
    df = windows(spark, GOOD)
    assert op.columns_required(df, ["window_start", "records"]).columns == ["window_start", "records"]
    with pytest.raises(ValueError, match=r"\['a', 'b'\]"):
        op.columns_required(df, ["records", "a", "b"])


def test_schema_parity(spark):
    batch = windows(spark, GOOD)
    other = batch.withColumnRenamed("records", "extra").withColumn(
        "injuries_total", batch.injuries_total.cast("int")
    )
    rows = {r.column_name: (r.batch_type, r.stream_type, r.status) for r in op.schema_parity(batch, other).collect()}
    assert rows == {
        "records": ("bigint", None, "batch_only"),
        "extra": (None, "bigint", "stream_only"),
        "injuries_total": ("bigint", "int", "type_differs"),
        "injuries_fatal": ("bigint", "bigint", "match"),
        "window_start": ("timestamp", "timestamp", "match"),
        "window_end": ("timestamp", "timestamp", "match"),
    }


def test_reconcile(spark):
    later = T + 5 * HOUR
    batch = windows(spark, [*GOOD, (7, 1, 1, T + 3 * HOUR, T + 4 * HOUR)])
    stream = windows(spark, [GOOD[0], (2, None, None, T + HOUR, T + 2 * HOUR), (4, 0, 0, later, later + HOUR)])
    rows = op.reconcile_windows(batch, stream, ["records", "injuries_total"]).collect()
    assert {r.window_start: (r.status, r.batch_records, r.stream_records) for r in rows} == {
        T: ("match", 3, 3),
        T + HOUR: ("differs", 1, 2),
        T + 3 * HOUR: ("missing_in_stream", 7, None),
        later: ("missing_in_batch", None, 4),
    }
    same = op.reconcile_windows(batch, batch, ["records", "injuries_total"])
    assert {r.status for r in same.collect()} == {"match"}  # NULL sums are equal
    twice = op.reconcile_windows(batch, batch.unionByName(batch.limit(1)), ["records"])
    assert sorted(r.status for r in twice.collect()) == ["duplicate", "match", "match"]
    longer = batch.withColumn("window_end", F.col("window_end") + F.expr("INTERVAL '1' HOUR"))
    statuses = {r.status for r in op.reconcile_windows(batch, longer, ["records"]).collect()}
    assert statuses == {"missing_in_stream", "missing_in_batch"}


def test_side_by_side(spark):
    sides = op.side_by_side(windows(spark, GOOD), windows(spark, GOOD[:1])).collect()
    assert {r.side: (r.windows, r.records, r.last_window) for r in sides} == {
        "batch": (2, 4, T + HOUR), "stream": (1, 3, T),
    }


def test_inventory_and_missing_output(spark, tmp_path):
    root = str(tmp_path / "gold")
    windows(spark, GOOD).coalesce(1).write.parquet(f"{root}/a")
    windows(spark, GOOD).repartition(2).write.parquet(f"{root}/b.c=d")
    rows = op.output_inventory(spark, root, ["a", "b.c=d", "none"]).collect()
    assert [(r.name, r.files, r.present) for r in rows] == [
        ("a", 1, True), ("b.c=d", 2, True), ("none", 0, False),
    ]
    assert rows[0].megabytes > 0 and rows[2].megabytes == 0

    (tmp_path / "queue").mkdir()
    state = [str(tmp_path / d) for d in ("out", "queue", "checkpoint")]
    assert read_output_or_none(spark, state[0]) is None
    assert tuple(table_status(spark, *state).first()) == (False, 0, False)
    windows(spark, GOOD).coalesce(1).write.mode("append").parquet(state[1])
    (tmp_path / "checkpoint").mkdir()
    assert tuple(table_status(spark, *state).first()) == (False, 1, False)
    (tmp_path / "checkpoint" / "metadata").write_text("{}")
    assert tuple(table_status(spark, f"{root}/a", *state[1:]).first()) == (True, 1, True)
    total = op.run_inventory(spark, {"arrived": state[1], "windows": state[0]}, state[2]).collect()
    assert {r.name: (r.files, r.present) for r in total} == {
        "checkpoint": (None, True), "arrived": (1, True), "windows": (0, False),
    }

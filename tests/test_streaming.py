import glob
import os
import shutil
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally.session import settings
from chronotally.sources import read_output, schema_of, taken_files, watch_folder
from chronotally.spec import CRASH_RECORDS, CRASH_ROLLUPS
from chronotally.streaming import (
    ProgressLog,
    check_restart,
    chunk_keys,
    deliver,
    finish,
    open_windows,
    progress_frame,
    replay_windows,
    run_totals,
    settle,
    start_windows,
    state_partitions,
    time_to_first_window,
    windowed,
    write_replay,
)
from crash_rows import clean_frame

SUMS = CRASH_ROLLUPS.window_sums
HOUR = timedelta(hours=1)
SCHEMA = CRASH_RECORDS.schema()


def days_of_crashes(first=datetime(2022, 1, 3), days=5, per_day=48):
    """One record each half hour, from Monday on; every seventh without a value."""
    return [
        (first + timedelta(days=d, minutes=30 * i), None if (d + i) % 7 == 0 else i % 4, i % 2, "CLEAR")
        for d in range(days)
        for i in range(per_day)
    ]


class Folders:
    def __init__(self, root):
        self.replay, self.watched, self.output, self.checkpoint = (
            str(root / n) for n in ("replay", "watched", "windows", "checkpoint")
        )


@pytest.fixture()
def at(tmp_path):
    return Folders(tmp_path)


@pytest.fixture(scope="module")
def crashes(spark):
    return clean_frame(spark, days_of_crashes())


def windows_of(df):
    """{start: (count, sums)} of a window table; fails if a window is there twice."""
    rows = df.collect()
    out = {r.window_start: (r.records, r.injuries_total, r.injuries_fatal) for r in rows}
    assert len(out) == len(rows)
    return out


def run_once(spark, at, max_files=None, **options):
    stream = watch_folder(spark, at.watched, SCHEMA, max_files)
    log = ProgressLog(spark)
    options = {"trigger": None, "log": log, **options}
    query = start_windows(windowed(stream, "CRASH_DATE", SUMS), at.output, at.checkpoint, **options)
    finish(query, 120)
    log.done(query)
    return progress_frame(log).orderBy("batch_id").collect()


def replay(spark, at, **options):
    return replay_windows(
        spark, at.replay, at.watched, at.output, at.checkpoint, SCHEMA, "CRASH_DATE", SUMS, **options
    )


# --- replay sets ----------------------------------------------------------------------------


def test_chunks_by_day_and_week(spark, crashes, tmp_path):
    for chunking, keys in (
        ("day", [date(2022, 1, d) for d in range(3, 8)]),
        ("week", [date(2022, 1, 3)]),
    ):
        path = str(tmp_path / chunking)
        timeless = crashes.limit(1).withColumn("CRASH_DATE", F.lit(None).cast("timestamp"))
        write_replay(timeless, "CRASH_DATE", f"{path}-timeless", chunking)
        assert chunk_keys(spark, f"{path}-timeless") == []
        write_replay(crashes, "CRASH_DATE", path, chunking)
        assert chunk_keys(spark, path) == keys
        stored = read_output(spark, path)
        assert dict(stored.dtypes)["chunk_key"] == "date"
        assert stored.drop("chunk_key").exceptAll(crashes.select(stored.drop("chunk_key").columns)).isEmpty()
        assert stored.count() == crashes.count()
        with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
            write_replay(crashes, "CRASH_DATE", path, chunking)
        write_replay(crashes, "CRASH_DATE", path, chunking, mode="overwrite")
        assert len(glob.glob(f"{path}/*/*.parquet")) == len(keys)  # one file for a small chunk
    with pytest.raises(ValueError, match="chunking"):
        write_replay(crashes, "CRASH_DATE", str(tmp_path / "x"), "month")


def test_hot_chunk_has_several_files_and_is_one_batch(spark, at):
    """One day holds most rows; its files arrive together, so none of them makes others late."""
    hot = spark.range(0, 40_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 512).alias("CRASH_RECORD_ID"),
        F.timestamp_seconds(F.lit(1641254400) + F.col("id") % 86400).alias("CRASH_DATE"),
        F.lit(1).alias("INJURIES_TOTAL"),
        F.lit(0).alias("INJURIES_FATAL"),
        *[F.lit("x").alias(c) for c in CRASH_RECORDS.columns[4:]],
        F.lit(2022).alias("year"),
        F.lit(1).alias("month"),
    )
    rest = clean_frame(spark, days_of_crashes(datetime(2022, 1, 3), 4))
    records = hot.unionByName(rest)
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}):
        write_replay(records, "CRASH_DATE", at.replay, "day")
    assert len(glob.glob(f"{at.replay}/chunk_key=2022-01-04/*.parquet")) > 2
    replay(spark, at)
    written = windows_of(read_output(spark, at.output))
    batch = windows_of(op.tumbling_windows(records, "CRASH_DATE", SUMS))
    last = max(batch)
    assert written == {t: v for t, v in batch.items() if t < last - HOUR}


def test_no_chunk_counts_twice_without_success_markers(spark, crashes, at):
    write_replay(crashes, "CRASH_DATE", at.replay, "day")
    with settings(spark, {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}):
        for _ in range(3):
            replay(spark, at)
    written = windows_of(read_output(spark, at.output))
    batch = windows_of(op.tumbling_windows(crashes, "CRASH_DATE", SUMS))
    assert written.items() <= batch.items() and len(written) == 5 * 24 - 2
    assert chunk_keys(spark, at.replay) == []


def test_a_live_stream_takes_each_chunk_in_one_batch(spark, crashes, at):
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        write_replay(crashes.repartition(4), "CRASH_DATE", at.replay, "day")
    os.makedirs(at.watched)
    windows = windowed(watch_folder(spark, at.watched, SCHEMA), "CRASH_DATE", SUMS)
    log = ProgressLog(spark, every_seconds=0.1, per_file=3)
    query = start_windows(windows, at.output, at.checkpoint, trigger="1 second", log=log)
    try:
        for key in chunk_keys(spark, at.replay):
            deliver(spark, at.replay, at.watched, key)
            settle(query, 60)
        while progress_frame(log).agg(F.sum("input_rows")).first()[0] != 240:  # known while it runs
            time.sleep(0.1)
    finally:
        query.stop()
        log.done(query)
    batches = progress_frame(log).orderBy("batch_id").collect()
    assert [b.input_rows for b in batches if b.input_rows] == [48] * 5
    assert [b.arrival for b in batches if b.input_rows] == list(range(5))
    assert len(windows_of(read_output(spark, at.output))) == 5 * 24 - 2


def test_all_batches_are_reported(spark, crashes, at):
    start = time.time() - 10_000
    for i in range(8):
        one_file(crashes.filter(F.crc32("CRASH_RECORD_ID") % 8 == i), at.watched, f"{i}.parquet", start + i)
    with settings(spark, {"spark.sql.streaming.numRecentProgressUpdates": "1"}):
        progress = run_once(spark, at, max_files=1)
    assert len(progress) >= 8 and sum(r.input_rows for r in progress) == crashes.count()
    assert [r.batch_id for r in progress] == list(range(len(progress)))


def test_taken_files_may_be_archived(spark, crashes, at, tmp_path):
    write_replay(crashes, "CRASH_DATE", at.replay, "day")
    log = replay(spark, at, archive=str(tmp_path / "archive"))
    assert len(windows_of(read_output(spark, at.output))) == 5 * 24 - 2
    assert glob.glob(f"{tmp_path}/archive/**/*.parquet", recursive=True)
    taken = taken_files(spark, at.checkpoint)
    assert run_totals(log, taken).first().files_in == taken.count() == 5
    assert {r.arrival for r in taken.collect()} == {b.arrival for b in progress_frame(log).collect()}


def test_files_taken_survive_a_compacted_log(spark, crashes, at):
    start = time.time() - 10_000
    for i in range(7):
        one_file(crashes.filter(F.crc32("CRASH_RECORD_ID") % 7 == i), at.watched, f"{i}.parquet", start + i)
    with settings(spark, {"spark.sql.streaming.fileSource.log.compactInterval": "3"}):
        run_once(spark, at, max_files=1)
    assert glob.glob(f"{at.checkpoint}/sources/0/*.compact")
    names = sorted(os.path.basename(r.path) for r in taken_files(spark, at.checkpoint).collect())
    assert names == [f"{i}.parquet" for i in range(7)]
    assert taken_files(spark, at.checkpoint + "-none").count() == 0


def test_open_windows_are_those_not_written(spark, crashes, at):
    assert open_windows(spark, at.checkpoint).count() == 0 and state_partitions(spark, at.checkpoint) is None
    write_replay(crashes, "CRASH_DATE", at.replay, "day")
    replay(spark, at, state_partitions=3)
    written = windows_of(read_output(spark, at.output))
    batch = windows_of(op.tumbling_windows(crashes, "CRASH_DATE", SUMS))
    still = {r.window_start: r.records for r in open_windows(spark, at.checkpoint).collect()}
    assert still == {t: v[0] for t, v in batch.items() if t not in written}
    assert state_partitions(spark, at.checkpoint) == 3


def test_a_restart_that_does_not_fit_is_refused(spark, crashes, at):
    write_replay(crashes, "CRASH_DATE", at.replay, "day")
    replay(spark, at, state_partitions=3)
    with pytest.raises(ValueError, match="3 state partitions, not 2"):
        replay(spark, at, state_partitions=2)
    with pytest.raises(ValueError, match="3600 s"):
        replay(spark, at, size="30 minutes")
    check_restart(spark, at.checkpoint, 3, "60 minutes")
    replay(spark, at, state_partitions=3)


def test_late_rows_are_counted_as_they_come(spark, at):
    """The second chunk is a repeat of the first: all of its closed windows' rows are late."""
    rows = days_of_crashes(days=2)
    frames = [clean_frame(spark, rows), clean_frame(spark, [*rows, (None, 1, 1, "x")])]
    for key, frame in zip(("2022-01-01", "2022-01-02"), frames):
        frame.write.parquet(f"{at.replay}/chunk_key={key}")
    log = replay(spark, at, count_late=True)
    batches = {b.arrival: b for b in progress_frame(log).collect() if b.input_rows}
    newest = max(t for t, *_ in rows)
    late = sum(t.replace(minute=0) + HOUR <= newest - HOUR for t, *_ in rows)
    assert [batches[i].late_rows for i in (0, 1)] == [0, late]
    assert batches[1].input_rows == len(rows) + 1


def test_late_rows_are_not_known_unless_observed(spark, crashes, at):
    crashes.write.parquet(at.watched)
    assert {b.late_rows for b in run_once(spark, at)} == {None}


def test_delivery_is_resumed(spark, crashes, at):
    write_replay(crashes, "CRASH_DATE", at.replay, "day")
    key = chunk_keys(spark, at.replay)[0]
    assert deliver(spark, at.replay, at.watched, key)
    assert key not in chunk_keys(spark, at.replay)
    assert not deliver(spark, at.replay, at.watched, key)
    rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(at.watched)
    assert rows.count() == 48


# --- windows --------------------------------------------------------------------------------


def test_stream_equals_batch_but_for_the_open_windows(spark, crashes, at):
    write_replay(crashes, "CRASH_DATE", at.replay, "day")
    reports = replay(spark, at)
    written = read_output(spark, at.output)
    batch = op.tumbling_windows(crashes, "CRASH_DATE", SUMS)
    assert written.dtypes == batch.dtypes
    want = windows_of(batch)
    newest = crashes.agg(F.max("CRASH_DATE")).first()[0]
    done = {t: v for t, v in want.items() if t + HOUR <= newest - HOUR}
    assert windows_of(written) == done and len(want) - len(done) == 2
    statuses = op.reconcile_windows(batch, written, ["records", *SUMS]).groupBy("status").count()
    assert dict(map(tuple, statuses.collect())) == {"match": len(done), "missing_in_stream": 2}

    batches = progress_frame(reports).orderBy("batch_id").collect()
    assert [b.input_rows for b in batches if b.input_rows] == [48] * 5
    assert sum(b.windows_out for b in batches) == len(done)
    assert batches[-1].state_rows == 2 and sum(b.rows_dropped for b in batches) == 0
    assert time_to_first_window(reports) > 0 and time_to_first_window(ProgressLog(spark)) is None
    totals = run_totals(reports, taken_files(spark, at.checkpoint)).first()
    assert (totals.input_rows, totals.windows_out, totals.files_in) == (240, len(done), 5)
    assert totals.batches == len(batches) and totals.seconds > 0

    # Fed again, nothing is new; a later chunk then lets the open windows out.
    replay(spark, at)
    assert windows_of(read_output(spark, at.output)) == done
    more = clean_frame(spark, days_of_crashes(datetime(2022, 1, 8), 1))
    write_replay(more, "CRASH_DATE", at.replay + "2", "day")
    at.replay += "2"
    replay(spark, at)
    assert set(want) < set(windows_of(read_output(spark, at.output)))


def test_other_sizes_and_delays(spark, crashes, at):
    write_replay(crashes, "CRASH_DATE", at.replay, "week")
    replay(spark, at, size="30 minutes", watermark="5 hours", count="n")
    written = read_output(spark, at.output)
    assert "n" in written.columns
    newest = crashes.agg(F.max("CRASH_DATE")).first()[0]
    assert written.agg(F.max("window_end")).first()[0] == newest - 5 * HOUR
    assert op.window_duration_checks(written, 1800).first().passed


def test_rocksdb_state(spark, crashes, at):
    crashes.write.parquet(at.watched)
    run_once(spark, at, rocksdb=True, state_partitions=2)
    assert read_output(spark, at.output).count() == 5 * 24 - 2
    assert len(glob.glob(f"{at.checkpoint}/state/0/[0-9]*")) == 2


def one_file(df, folder, name, modified):
    """A single Parquet file with a given name and age, as another system would drop it."""
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}-staging")
    os.makedirs(folder, exist_ok=True)
    part = glob.glob(f"{folder}-staging/part-*.parquet")[0]
    shutil.copyfile(part, f"{folder}/{name}")
    os.utime(f"{folder}/{name}", (modified, modified))


def test_late_rows_follow_the_watermark_of_the_batch_before(spark, at):
    """Several files per day, one file per batch: a row is dropped iff its window's end is not
    after the watermark that the batch before it used."""
    rows = days_of_crashes(days=3)
    start = time.time() - 10_000
    files = [(d, k) for d in range(3) for k in range(3)]
    batches = []
    for i, (d, k) in enumerate(files):
        part = [r for j, r in enumerate(rows) if r[0].day == 3 + d and j % 3 == k]
        batches.append(part)
        one_file(clean_frame(spark, part), at.watched, f"{i}.parquet", start + i)
    run_once(spark, at, max_files=1)

    newest, used, counted = None, [None], {}
    for part in batches:
        late = used[-2] if len(used) > 1 else None
        for t, *_ in part:
            window = t.replace(minute=0)
            if late is None or window + HOUR > late:
                counted[window] = counted.get(window, 0) + 1
        newest = max([t for t, *_ in part] + ([newest] if newest else []))
        used.append(newest - HOUR)
    want = {t: n for t, n in counted.items() if t + HOUR <= newest - HOUR}
    written = windows_of(read_output(spark, at.output))
    assert {t: v[0] for t, v in written.items()} == want
    assert sum(want.values()) < sum(t + HOUR <= newest for t, *_ in rows) - 2  # some were dropped


def test_a_delay_as_long_as_the_chunk_loses_nothing(spark, at):
    rows = days_of_crashes(days=3)
    start = time.time() - 10_000
    for i, (d, k) in enumerate((d, k) for d in range(3) for k in range(2)):
        part = [r for j, r in enumerate(rows) if r[0].day == 3 + d and j % 2 == k]
        one_file(clean_frame(spark, part), at.watched, f"{i}.parquet", start + i)
    stream = watch_folder(spark, at.watched, SCHEMA, 1)
    windows = windowed(stream, "CRASH_DATE", SUMS, watermark="25 hours")
    finish(start_windows(windows, at.output, at.checkpoint, trigger=None), 120)
    batch = windows_of(op.tumbling_windows(clean_frame(spark, rows), "CRASH_DATE", SUMS))
    written = windows_of(read_output(spark, at.output))
    assert written and written.items() <= batch.items()
    assert len(written) == 3 * 24 - 26


def test_other_files_in_the_folder_are_left_alone(spark, crashes, at):
    one_file(crashes, at.watched, "a.parquet", time.time())
    one_file(crashes, at.watched, "b.parquet.tmp", time.time())
    assert sum(p.input_rows for p in run_once(spark, at)) == crashes.count()


def test_stray_output_file_is_not_read(spark, crashes, at):
    crashes.write.parquet(at.watched)
    run_once(spark, at)
    before = windows_of(read_output(spark, at.output))
    read_output(spark, at.output).write.mode("append").parquet(at.output)
    assert windows_of(read_output(spark, at.output)) == before
    names = glob.glob(f"{at.output}/*.parquet")
    assert spark.read.parquet(*names).count() > len(before)  # a plain list of files reads it


def test_restart_from_the_checkpoint(spark, crashes, at):
    write_replay(crashes, "CRASH_DATE", at.replay, "day")
    keys = chunk_keys(spark, at.replay)
    for key in keys[:2]:
        deliver(spark, at.replay, at.watched, key)
    run_once(spark, at)
    first = windows_of(read_output(spark, at.output))
    for key in keys[2:]:
        deliver(spark, at.replay, at.watched, key)
    assert sum(p.input_rows for p in run_once(spark, at)) == 3 * 48  # only what is new
    both = windows_of(read_output(spark, at.output))
    assert first.items() < both.items() and len(both) == 5 * 24 - 2


def test_processing_time_trigger(spark, crashes, at):
    crashes.write.parquet(at.watched)
    schema = schema_of(spark, at.watched)
    windows = windowed(watch_folder(spark, at.watched, schema), "CRASH_DATE", SUMS)
    query = start_windows(windows, at.output, at.checkpoint, trigger="1 second")
    try:
        query.processAllAvailable()
        with pytest.raises(TimeoutError):
            finish(query, 1)  # it does not end by itself
    finally:
        query.stop()
    assert not query.isActive
    assert read_output(spark, at.output).count() == 5 * 24 - 2


def test_zoneless_time_takes_no_watermark(spark, at):
    df = spark.readStream.schema("t timestamp_ntz").parquet(at.watched) if os.makedirs(at.watched) is None else None
    with pytest.raises(AnalysisException, match="EVENT_TIME_IS_NOT_ON_TIMESTAMP_TYPE"):
        windowed(df, "t", {})


def test_settings_are_put_back(spark, crashes, at):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    crashes.write.parquet(at.watched)
    run_once(spark, at, state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert len(glob.glob(f"{at.checkpoint}/state/0/[0-9]*")) == 3

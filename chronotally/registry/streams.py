"""Hour windows over events that arrive week by week, and their comparison with the batch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally.registry.base import query
from chronotally.registry.batch import HOURS_SQL
from chronotally.registry.tables import EVENT_SUMS, EVENTS_SQL, event_instants
from chronotally.session import run_folder
from chronotally.sources import read_output, schema_of, table_status, taken_files, watch_folder
from chronotally.streaming import (
    ProgressLog,
    chunk_keys,
    deliver,
    finish,
    open_windows,
    progress_frame,
    replay_windows,
    run_totals,
    start_windows,
    windowed,
    write_replay,
)

# Windows written once all events have arrived: those the watermark has passed.
_DONE_SQL = f"""
{HOURS_SQL},
done as (
  select * from hours where window_end <= (select max(ts) - interval '1 hour' from events)
)"""


@dataclass
class Run:
    """The folders of one replay and what its batches reported."""

    replay: str
    watched: str
    output: str
    checkpoint: str
    log: ProgressLog | None


def _folders(spark: SparkSession, label: str) -> Run:
    root = run_folder(spark, label)
    return Run(f"{root}/replay", f"{root}/arrived", f"{root}/windows", f"{root}/checkpoint", None)


def _replay(
    spark: SparkSession, records: DataFrame, label: str, arrival: str | None = None, **options
) -> Run:
    run = _folders(spark, label)
    write_replay(records, "ts", run.replay, "week", arrival=arrival)
    run.log = replay_windows(
        spark,
        run.replay,
        run.watched,
        run.output,
        run.checkpoint,
        records.schema,
        "ts",
        EVENT_SUMS,
        **options,
    )
    return run


@query("stream_hourly_windows", f"with {_DONE_SQL} select * from done")
def stream_hourly_windows(spark: SparkSession, folder: str) -> DataFrame:
    return read_output(spark, _replay(spark, event_instants(spark, folder), "hours").output)


_ARRIVALS_SQL = f"""
{HOURS_SQL},
arrivals as (
  select date_trunc('week', ts) as chunk, count(*) as input_rows, max(ts) as top from events group by 1
),
marked as (
  select *, row_number() over (order by chunk) - 1 as run,
    max(top) over (order by chunk) - interval '1 hour' as mark
  from arrivals
),
finished as (
  select run, input_rows, (select count(*) from hours where window_end <= mark) as so_far from marked
)"""


@query(
    "stream_progress",
    f"""with {_ARRIVALS_SQL}
    select cast(run as integer) as run, input_rows,
      so_far - coalesce(lag(so_far) over (order by run), 0) as windows_out
    from finished""",
)
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Rows taken in and windows written per arrival; batches without input only move the watermark."""
    run = _replay(spark, event_instants(spark, folder), "progress")
    return (
        progress_frame(run.log)
        .groupBy(F.col("arrival").alias("run"))
        .agg(
            F.sum("input_rows").alias("input_rows"),
            F.coalesce(F.sum("windows_out"), F.lit(0)).alias("windows_out"),
        )
    )


@query(
    "stream_run_totals",
    f"""with {_ARRIVALS_SQL}
    select (select count(*) from events) as input_rows, max(so_far) as windows_out,
      true as timed, true as all_files_in from finished""",
)
def stream_run_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run in one row; how many batches and files it took depends on the cluster."""
    run = _replay(spark, event_instants(spark, folder), "totals")
    totals = run_totals(run.log, taken_files(spark, run.checkpoint))
    return totals.select(
        "input_rows", "windows_out", (F.col("seconds") > 0).alias("timed"),
        (F.col("files_in") >= 5).alias("all_files_in"),
    )


@query(
    "stream_files_taken",
    """with weeks as (select distinct cast(date_trunc('week', ts) as date) as chunk_key from events)
    select 'archived' as side, chunk_key from weeks union all select 'left', chunk_key from weeks""",
)
def stream_files_taken(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks whose files were taken in, by the source's own log, whether or not files are archived."""
    records, archive = event_instants(spark, folder), run_folder(spark, "archive")
    runs = {
        "archived": _replay(spark, records, "taken-archived", archive=archive),
        "left": _replay(spark, records, "taken-left"),
    }
    key = F.to_date(F.regexp_extract("path", r"/arrived/(\d{4}-\d{2}-\d{2})/", 1))
    sides = [
        taken_files(spark, run.checkpoint).select(F.lit(side).alias("side"), key.alias("chunk_key")).distinct()
        for side, run in runs.items()
    ]
    return sides[0].unionByName(sides[1])


@query(
    "stream_open_windows",
    f"""with {_DONE_SQL} select window_start, window_end, records from hours
    where window_start not in (select window_start from done)""",
)
def stream_open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The windows still in the state at the end: those of the batch that were not written."""
    run = _replay(spark, event_instants(spark, folder), "open")
    return open_windows(spark, run.checkpoint).drop("partition")


@query("stream_borrowed_schema", f"with {_DONE_SQL} select * from done")
def stream_borrowed_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The watched folder is empty when the stream is made: its schema is that of the stored table."""
    run = _folders(spark, "borrowed")
    event_instants(spark, folder).write.parquet(run.replay)
    run.log = replay_windows(
        spark, f"{run.replay}-none", run.watched, run.output, run.checkpoint, schema_of(spark, run.replay), "ts", EVENT_SUMS
    )
    spark.read.parquet(run.replay).write.parquet(f"{run.watched}/all")
    _run_arrived(spark, run, schema_of(spark, run.replay))
    return read_output(spark, run.output)


_JUDGED_SQL = f"""{EVENTS_SQL},
    arrived as (
      select *, date_trunc('week', case when event_type = 'error' then ts + interval '7 days'
        else ts end) as chunk, time_bucket(interval '1 hour', ts) as window_start
      from e
    ),
    highest as (select chunk, max(ts) as top from arrived group by 1),
    marks as (
      select chunk, max(top) over (order by chunk rows between unbounded preceding and 1 preceding)
        - interval '1 hour' as mark
      from highest
    ),
    judged as (
      select a.*, coalesce(window_start + interval '1 hour' > mark, true) as in_time
      from arrived a join marks using (chunk)
    )"""


def _arrival() -> Column:
    """Errors are reported a week late, when most of their windows are closed."""
    week = F.expr("INTERVAL '7' DAY")
    return F.when(F.col("event_type") == "error", F.col("ts") + week).otherwise(F.col("ts"))


@query(
    "stream_late_counts",
    f"""with {_JUDGED_SQL}
    select cast(row_number() over (order by chunk) - 1 as integer) as arrival, count(*) as input_rows,
      count(*) filter (not in_time) as late_rows
    from judged group by chunk""",
)
def stream_late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Late rows of each arrival, counted while the stream runs."""
    records = event_instants(spark, folder).withColumn("arrival", _arrival())
    run = _replay(spark, records, "late-counts", arrival="arrival", count_late=True)
    counts = [F.sum(c).alias(c) for c in ("input_rows", "late_rows")]
    return progress_frame(run.log).groupBy("arrival").agg(*counts)


@query(
    "stream_late_rows",
    f"""with {_JUDGED_SQL}
    select window_start, count(*) as records, count(*) filter (in_time) as counted,
      count(*) filter (not in_time) as late
    from judged
    where window_start + interval '1 hour' <= (select max(ts) - interval '1 hour' from events)
    group by 1""",
)
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Records by window, those that came in time and those that were late."""
    records = event_instants(spark, folder)
    run = _replay(spark, records.withColumn("arrival", _arrival()), "late", arrival="arrival")
    written = read_output(spark, run.output).select("window_start", F.col("records").alias("counted"))
    # The windows that are closed at the end, those without a single record in time as well.
    newest = records.agg(F.max("ts").alias("newest"))
    counted = F.coalesce("counted", F.lit(0))
    return (
        op.tumbling_windows(records, "ts", {}, count="records")
        .crossJoin(F.broadcast(newest))  # one row
        .filter(F.col("window_end") <= F.col("newest") - F.expr("INTERVAL '1' HOUR"))
        .join(written, "window_start", "left")
        .select(
            "window_start", "records", counted.alias("counted"), (F.col("records") - counted).alias("late")
        )
    )


def _run_arrived(spark: SparkSession, run: Run, schema) -> None:
    """One run over whatever has arrived since the last."""
    stream = watch_folder(spark, run.watched, schema)
    windows = windowed(stream, "ts", EVENT_SUMS)
    finish(start_windows(windows, run.output, run.checkpoint, trigger=None))


@query(
    "stream_restart",
    f"""with {HOURS_SQL},
    first_leg as (select max(ts) - interval '1 hour' as mark from events
      where date_trunc('week', ts) in (select distinct date_trunc('week', ts) as w from events
        order by w limit 3)),
    second_leg as (select max(ts) - interval '1 hour' as mark from events)
    select 1 as leg, count(*) as windows, cast(sum(records) as bigint) as records,
      count(*) - count(distinct window_start) as repeated
    from hours where window_end <= (select mark from first_leg)
    union all
    select 2, count(*), cast(sum(records) as bigint), count(*) - count(distinct window_start)
    from hours where window_end <= (select mark from second_leg)""",
)
def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Three weeks, a stop, then the rest from the same checkpoint: no window twice."""
    records = event_instants(spark, folder)
    run = _folders(spark, "restart")
    write_replay(records, "ts", run.replay, "week")
    keys = chunk_keys(spark, run.replay)

    def leg(number: int, arriving: list) -> DataFrame:
        for key in arriving:
            deliver(spark, run.replay, run.watched, key)
        _run_arrived(spark, run, records.schema)
        # Which files belong to the output is settled here, before the next leg.
        return read_output(spark, run.output).agg(
            F.lit(number).alias("leg"),
            F.count("*").alias("windows"),
            F.sum("records").alias("records"),
            (F.count("*") - F.count_distinct("window_start")).alias("repeated"),
        )

    return leg(1, keys[:3]).unionByName(leg(2, keys[3:]))


@query(
    "stream_output_readback",
    f"""with {_DONE_SQL}
    select cast(window_start as date) as date, count(*) as windows,
      cast(sum(records) as bigint) as records
    from done group by 1""",
)
def stream_output_readback(spark: SparkSession, folder: str) -> DataFrame:
    """A file that no batch committed lies in the output folder and must not be read."""
    run = _replay(spark, event_instants(spark, folder), "stray")
    read_output(spark, run.output).write.mode("append").parquet(run.output)
    return (
        read_output(spark, run.output)
        .groupBy(F.to_date("window_start").alias("date"))
        .agg(F.count("*").alias("windows"), F.sum("records").alias("records"))
    )


# --- batch against stream -------------------------------------------------------------------


def _both_sides(spark: SparkSession, folder: str, label: str) -> tuple[DataFrame, DataFrame]:
    records = event_instants(spark, folder)
    batch = op.tumbling_windows(records, "ts", EVENT_SUMS)
    return batch, read_output(spark, _replay(spark, records, label).output)


@query(
    "batch_stream_reconcile",
    f"""with {_DONE_SQL}
    select h.window_start, h.window_end,
      case when d.window_start is null then 'missing_in_stream' else 'match' end as status,
      h.records as batch_records, h.k_total as batch_k_total,
      h.error_k_total as batch_error_k_total,
      d.records as stream_records, d.k_total as stream_k_total,
      d.error_k_total as stream_error_k_total
    from hours h left join done d using (window_start)""",
)
def batch_stream_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    batch, stream = _both_sides(spark, folder, "reconcile")
    return op.reconcile_windows(batch, stream, ["records", *EVENT_SUMS])


@query(
    "batch_stream_side_by_side",
    f"""with {_DONE_SQL}
    select 'batch' as side, count(*) as windows, cast(sum(records) as bigint) as records,
      min(window_start) as first_window, max(window_start) as last_window from hours
    union all
    select 'stream', count(*), cast(sum(records) as bigint), min(window_start), max(window_start)
    from done""",
)
def batch_stream_side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    return op.side_by_side(*_both_sides(spark, folder, "sides"))


@query(
    "reconcile_faults",
    f"""with {_DONE_SQL}
    select h.window_start, h.window_end,
      case extract(hour from h.window_start) % 4 when 0 then 'duplicate' when 1 then 'missing_in_stream'
        when 2 then 'differs' else 'match' end as status
    from done h""",
)
def reconcile_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Windows that are twice, missing or changed in the stream's output are told apart."""
    batch, stream = _both_sides(spark, folder, "faults")
    turn = F.hour("window_start") % 4
    kept = stream.filter(turn != 1).withColumn(
        "records", F.when(turn == 2, F.col("records") + 1).otherwise(F.col("records"))
    )
    faulty = kept.unionByName(stream.filter(turn == 0))
    done = batch.join(stream.select("window_start"), "window_start", "left_semi")
    return op.reconcile_windows(done, faulty, ["records"]).select("window_start", "window_end", "status")


@query(
    "schema_parity",
    """select * from (values ('records', 'bigint', 'bigint', 'match'),
      ('k_total', 'bigint', 'int', 'type_differs'), ('error_k_total', 'bigint', null, 'batch_only'),
      ('arrived', null, 'date', 'stream_only'), ('window_start', 'timestamp', 'timestamp', 'match'),
      ('window_end', 'timestamp', 'timestamp', 'match')) t(column_name, batch_type, stream_type, status)""",
)
def schema_parity(spark: SparkSession, folder: str) -> DataFrame:
    """One column of the stream's output has another type, one another name."""
    batch, stream = _both_sides(spark, folder, "parity")
    other = stream.withColumns({"k_total": F.col("k_total").cast("int"), "arrived": F.to_date("window_end")})
    return op.schema_parity(batch, other.drop("error_k_total"))


@query(
    "stream_inventory",
    """select 'replay' as name, count(*) < 0 as present from events
    union all select 'arrived', count(*) > 0 from events
    union all select 'windows', count(*) > 0 from events
    union all select 'checkpoint', count(*) > 0 from events
    union all select 'all, missing: replay', false""",
)
def stream_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """All has been handed over: the replay set is used up, the rest is there."""
    run = _replay(spark, event_instants(spark, folder), "files")
    folders = {"replay": run.replay, "arrived": run.watched, "windows": run.output}
    inventory = op.run_inventory(spark, folders, run.checkpoint)
    whole = op.all_present(inventory).select(
        F.concat(F.lit("all, missing: "), "missing").alias("name"), "present"
    )
    return inventory.select("name", "present").unionByName(whole)


@query(
    "output_status",
    """select 'before' as moment, count(*) < 0 as output_found, count(*) > 0 as queued,
      count(*) < 0 as checkpoint_found from events
    union all select 'after', count(*) > 0, count(*) > 0, count(*) > 0 from events""",
)
def output_status(spark: SparkSession, folder: str) -> DataFrame:
    """What can be read and what waits, before and after the run."""
    records = event_instants(spark, folder)
    run = _folders(spark, "status")
    records.write.parquet(f"{run.watched}/all")
    places = (run.output, run.watched, run.checkpoint)
    before = table_status(spark, *places)
    _run_arrived(spark, run, records.schema)
    rows = {"before": before, "after": table_status(spark, *places)}
    parts = [
        df.select(F.lit(k).alias("moment"), "output_found", (F.col("files_queued") > 0).alias("queued"), "checkpoint_found")
        for k, df in rows.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "stream_ignores_other_names",
    f"with {_DONE_SQL} select count(*) as windows, cast(sum(records) as bigint) as records from done",
)
def stream_ignores_other_names(spark: SparkSession, folder: str) -> DataFrame:
    """A copy of all records lies in the watched folder under names that do not match."""
    records = event_instants(spark, folder)
    run = _folders(spark, "names")
    records.write.parquet(f"{run.watched}/all")
    records.write.json(f"{run.watched}/copy")
    _run_arrived(spark, run, records.schema)
    return read_output(spark, run.output).agg(
        F.count("*").alias("windows"), F.sum("records").alias("records")
    )


@query(
    "stream_trigger",
    f"with {_DONE_SQL} select * from done",
)
def stream_trigger(spark: SparkSession, folder: str) -> DataFrame:
    """A query on a processing-time trigger, stopped when nothing is left to take."""
    records = event_instants(spark, folder)
    run = _folders(spark, "trigger")
    records.write.parquet(f"{run.watched}/all")
    windows = windowed(watch_folder(spark, run.watched, records.schema), "ts", EVENT_SUMS)
    live = start_windows(windows, run.output, run.checkpoint, trigger="1 second")
    try:
        live.processAllAvailable()
    finally:
        live.stop()
    return read_output(spark, run.output)

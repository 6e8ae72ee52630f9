"""What a streaming run did, batch by batch."""

from __future__ import annotations

import json
import threading
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronotally.session import make_folder, run_folder, write_text

#: The name under which late rows are observed, see :func:`late_observed`.
LATE = "late"
# So many reports the queries of a session hold at least, between two looks at them.
_RETENTION, _RETAINED = "spark.sql.streaming.numRecentProgressUpdates", 1000

_REPORT = (
    "id string, runId string, batchId bigint, timestamp timestamp, numInputRows bigint, "
    "durationMs struct<triggerExecution: bigint>, eventTime struct<watermark: timestamp>, "
    "stateOperators array<struct<numRowsRemoved: bigint, numRowsDroppedByWatermark: bigint, numRowsTotal: bigint>>, "
    f"observedMetrics struct<{LATE}: struct<rows: bigint, windows: array<struct<item: bigint, count: bigint>>>>"
)


class ProgressLog:
    """The reports of all batches of the queries it follows, as JSON lines in a folder.

    Spark holds the last reports of a query in the driver's memory only. A thread looks at each query
    while it runs, also a long-running one, and appends what is new to the folder, ``per_file`` reports at a
    time; that many are held here at most. The session's queries are made to retain at least 1,000 reports, more
    than come between two looks. (A listener would need a port for Spark to call back.)
    """

    def __init__(self, spark: SparkSession, path: str | None = None, every_seconds: float = 0.5, per_file: int = 20):
        self.spark, self.path = spark, path or run_folder(spark, "progress")
        self.every, self.per_file = every_seconds, per_file
        self.began, self.ended = time.time(), None
        self._waiting: list[str] = []
        self._last: dict[str, tuple] = {}
        self._threads: dict[str, threading.Thread] = {}
        self._lock = threading.Lock()
        make_folder(spark, self.path)

    def follow(self, query: StreamingQuery) -> None:
        """Take the reports of ``query`` from now until it ends."""
        if int(self.spark.conf.get(_RETENTION)) < _RETAINED:
            self.spark.conf.set(_RETENTION, str(_RETAINED))
        thread = threading.Thread(target=self._run, args=(query,), daemon=True)
        self._threads[str(query.runId)] = thread
        thread.start()

    def _run(self, query: StreamingQuery) -> None:
        running = True
        while running:
            running = query.isActive  # asked first, so that the last look comes after the end
            self.take(query)
            if running:
                time.sleep(self.every)
        self.flush()

    def take(self, query: StreamingQuery) -> None:
        """Take what is new."""
        with self._lock:
            found = [(json.loads(p.json), p.json) for p in query.recentProgress]
            last = self._last.get(str(query.runId), (-1, ""))
            new = [(r["batchId"], r["timestamp"], text) for r, text in found if (r["batchId"], r["timestamp"]) > last]
            if new:
                self._last[str(query.runId)] = new[-1][:2]
                self._waiting += [json.dumps(json.loads(text)) for *_, text in new]
            if len(self._waiting) >= self.per_file:
                self._write()

    def _write(self) -> None:
        if self._waiting:
            write_text(self.spark, f"{self.path}/{uuid.uuid4().hex}.json", "\n".join(self._waiting) + "\n")
            self._waiting = []

    def flush(self) -> None:
        with self._lock:
            self._write()

    def done(self, query: StreamingQuery) -> None:
        """Wait until the last report of a query that has ended is taken."""
        thread = self._threads.pop(str(query.runId), None)
        if thread is not None:
            thread.join()
        self._last.pop(str(query.runId), None)

    def reports(self) -> DataFrame:
        """One row per batch, as Spark reports it; of a batch that was run again the last report. Reports of
        idle times, which ran no batch, are left out."""
        self.flush()
        last = Window.partitionBy("id", "batchId").orderBy(F.desc("timestamp"))
        found = self.spark.read.schema(_REPORT).json(self.path).filter(F.size("stateOperators") > 0)
        return found.withColumn("_nth", F.row_number().over(last)).filter("_nth = 1").drop("_nth")


def late_observed(stream: DataFrame, event_time: str, size: str) -> DataFrame:
    """``stream`` with the number of its rows by window end in the report of each batch. The watermark that
    decides is known when a batch has run; a batch has few windows, so all are counted."""
    end = F.unix_seconds(F.window(event_time, size)["end"])
    return (
        stream.withColumn("_window_end", end)
        .observe(
            LATE,
            F.count("_window_end").alias("rows"),
            F.expr("approx_top_k(_window_end, 100000, 1000000)").alias("windows"),
        )
        .drop("_window_end")
    )


def _late(previous: Column) -> Column:
    """Rows whose window had ended for the batch before. The counts are exact as long as all windows of the
    batch are among them; else the number is not known."""
    windows = F.col(f"observedMetrics.{LATE}.windows")

    def total(some: Column) -> Column:
        return F.aggregate(some, F.lit(0).cast("bigint"), lambda n, w: n + w["count"])

    known = total(windows) == F.col(f"observedMetrics.{LATE}.rows")
    closed = F.filter(windows, lambda w: w["item"] * 1000 <= F.unix_millis(previous))
    first = F.col("batchId") == 0
    return F.when(known & first, 0).when(known & previous.isNotNull(), total(closed)).cast("bigint")


def progress_frame(log: ProgressLog) -> DataFrame:
    """One row per batch. ``arrival`` counts the batches with input, and a batch without belongs to the one
    before. ``late_rows`` is known where late rows are observed (:func:`late_observed`); ``rows_dropped`` is
    Spark's number of groups dropped after partial aggregation, a lower bound of it."""
    so_far = Window.partitionBy("id").orderBy("batchId")
    state = F.get("stateOperators", F.lit(0))
    previous = F.lag("eventTime.watermark").over(so_far)
    arrivals = F.sum((F.col("numInputRows") > 0).cast("int")).over(so_far)
    return log.reports().select(
        F.col("id").alias("query"),
        F.col("batchId").alias("batch_id"),
        F.greatest(arrivals - 1, F.lit(0)).cast("int").alias("arrival"),
        F.col("timestamp").alias("started"),
        F.col("numInputRows").alias("input_rows"),
        F.col("durationMs.triggerExecution").alias("duration_ms"),
        F.col("eventTime.watermark").alias("watermark"),
        state["numRowsRemoved"].alias("windows_out"),
        state["numRowsDroppedByWatermark"].alias("rows_dropped"),
        _late(previous).alias("late_rows"),
        state["numRowsTotal"].alias("state_rows"),
    )


def run_totals(log: ProgressLog, taken: DataFrame) -> DataFrame:
    """One row for the whole run: batches, input rows, windows written, files taken in (of
    :func:`chronotally.sources.taken_files`), and seconds from the first delivery to the end."""
    seconds = (log.ended or time.time()) - log.began
    files = taken.agg(F.count_distinct("path").alias("files_in"))
    return (
        progress_frame(log)
        .agg(
            F.count("*").alias("batches"),
            F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
            F.coalesce(F.sum("windows_out"), F.lit(0)).alias("windows_out"),
        )
        .join(files, F.lit(True))  # one row each
        .withColumn("seconds", F.lit(float(seconds)))
    )


def time_to_first_window(log: ProgressLog) -> float | None:
    """Seconds from before the first delivery to the end of the first batch that wrote a window."""
    first = progress_frame(log).filter("windows_out > 0").orderBy("started").limit(1)
    row = first.select((F.unix_millis("started") + F.col("duration_ms")).alias("ended")).first()
    return None if row is None else row.ended / 1000 - log.began

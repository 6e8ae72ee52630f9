"""Tumbling event-time windows over arriving files."""

from __future__ import annotations

import threading
import time
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chronotally.operators.rollups import tumbling_windows
from chronotally.session import make_folder, settings
from chronotally.sources.tables import watch_folder
from chronotally.streaming.progress import ProgressLog, late_observed
from chronotally.streaming.replay import chunk_keys, deliver
from chronotally.streaming.state import check_restart

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def windowed(
    stream: DataFrame,
    event_time: str,
    measures: Mapping[str, str],
    size: str = "1 hour",
    watermark: str = "1 hour",
    count: str = "records",
    count_late: bool = False,
) -> DataFrame:
    """The batch aggregation on a stream, with a bound on how late a record may come.

    A record is dropped once its window's end is not after the watermark, and a window is
    written once the watermark has passed its end; the last windows wait for newer records.
    ``count_late`` has the rows of each batch counted by window ahead of that, from which
    ``progress_frame`` tells how many were late.
    """
    marked = stream.withWatermark(event_time, watermark)
    if count_late:
        marked = late_observed(marked, event_time, size)
    return tumbling_windows(marked, event_time, measures, size, count)


def start_windows(
    windows: DataFrame,
    output: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    state_partitions: int | None = None,
    output_files: int | None = None,
    rocksdb: bool = False,
    size: str | None = None,
    log: ProgressLog | None = None,
) -> StreamingQuery:
    """Append finished windows to Parquet, each exactly once across restarts.

    ``trigger=None`` takes everything that has arrived and ends. The state has as many partitions
    as the session's shuffles, or ``state_partitions``; the first run fixes it. Each writes a
    file of its own, or finished windows of a batch go to ``output_files`` files by a further
    exchange. A restart with other ``state_partitions`` or another window ``size`` is refused. ``log``
    takes the reports of all batches while the query runs.
    """
    check_restart(windows.sparkSession, checkpoint, state_partitions, size)
    conf = {}
    if state_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    if rocksdb:
        conf["spark.sql.streaming.stateStore.providerClass"] = _ROCKSDB
    writer = (
        (windows if output_files is None else windows.repartition(output_files))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    writer = (
        writer.trigger(availableNow=True)
        if trigger is None
        else writer.trigger(processingTime=trigger)
    )
    with settings(windows.sparkSession, conf):
        query = writer.start(output)
    if log is not None:
        log.follow(query)
    return query


def finish(query: StreamingQuery, timeout_seconds: float | None = None) -> StreamingQuery:
    """Wait for a query that ends by itself; stop it and complain if it does not in the time given."""
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout_seconds} s")
    return query


def settle(query: StreamingQuery, timeout_seconds: float | None = None) -> None:
    """Wait until a running query has taken everything that has arrived; stop it and complain if it
    has not in the time given."""
    failed: list[Exception] = []

    def wait() -> None:
        try:
            query.processAllAvailable()
        except Exception as error:  # handed on below
            failed.append(error)

    waiting = threading.Thread(target=wait, daemon=True)
    waiting.start()
    waiting.join(timeout_seconds)
    if waiting.is_alive():
        query.stop()
        raise TimeoutError(f"streaming query still busy after {timeout_seconds} s")
    if failed:
        raise failed[0]


def replay_windows(
    spark: SparkSession,
    replay: str,
    watched: str,
    output: str,
    checkpoint: str,
    schema: T.StructType,
    event_time: str,
    measures: Mapping[str, str],
    size: str = "1 hour",
    watermark: str = "1 hour",
    count: str = "records",
    keys: Sequence[date] | None = None,
    timeout_seconds: float | None = None,
    archive: str | None = None,
    count_late: bool = False,
    log: ProgressLog | None = None,
    **start_options,
) -> ProgressLog:
    """Feed the chunks of a replay set in order to one running query, and return the log of all batches.

    A chunk is handed over as a whole once the query has taken the one before, so it is one batch
    however many files it has, and its own first file cannot make the rest of it late. A later call goes
    on from the checkpoint, first with what a run before may have left behind; chunks that arrived before
    are not fed again. ``timeout_seconds`` is for each chunk.
    """
    make_folder(spark, watched)
    stream = watch_folder(spark, watched, schema, archive=archive)
    windows = windowed(stream, event_time, measures, size, watermark, count, count_late)
    log = ProgressLog(spark) if log is None else log
    query = start_windows(windows, output, checkpoint, trigger="0 seconds", size=size, log=log, **start_options)
    try:
        settle(query, timeout_seconds)
        for key in chunk_keys(spark, replay) if keys is None else keys:
            deliver(spark, replay, watched, key)
            settle(query, timeout_seconds)
    finally:
        query.stop()
        log.done(query)
    log.ended = time.time()
    return log

"""Replay a stored table as files that arrive chunk by chunk."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.functions.calendar import week_start
from chronotally.session import child_names, moved, path_exists
from chronotally.sinks.parquet import write_partitioned

# How Spark names the folders of a partitioned table.
_KEY = "chunk_key="
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"

CHUNKINGS = {"day": F.to_date, "week": week_start}


def write_replay(
    df: DataFrame,
    event_time: str,
    path: str,
    chunking: str = "day",
    mode: str = "errorifexists",
    arrival: str | None = None,
) -> None:
    """Store ``df`` as ``chunk_key=YYYY-MM-DD`` folders, one per day or per week (its Monday).

    ``arrival`` names the column that decides the chunk where records come later than their
    event time. A chunk is few files, but never forced into one.
    """
    if chunking not in CHUNKINGS:
        raise ValueError(f"chunking must be one of {sorted(CHUNKINGS)}, not {chunking!r}")
    chunked = df.withColumn("chunk_key", CHUNKINGS[chunking](F.col(arrival or event_time)))
    write_partitioned(chunked, path, ["chunk_key"], mode=mode)


def chunk_keys(spark: SparkSession, path: str) -> list[date]:
    """The chunks of a replay set in time order: at most one per calendar day, taken from the
    folder names. Records without a time have no chunk; no window would count them."""
    if not path_exists(spark, path):
        return []
    names = (n.removeprefix(_KEY) for n in child_names(spark, path) if n.startswith(_KEY))
    return sorted(date.fromisoformat(n) for n in names if n != _NO_KEY)


def deliver(spark: SparkSession, replay: str, watched: str, key: date) -> bool:
    """Hand one chunk over to the watched folder; False if it had arrived before.

    Its folder is renamed: a stream sees all of its files or none, and no file twice. The replay
    set is used up by it. Object stores rename file by file; a stream that runs meanwhile may
    there take a chunk in several batches and needs a delay as long as a chunk.
    """
    return moved(spark, f"{replay}/{_KEY}{key.isoformat()}", f"{watched}/{key.isoformat()}")

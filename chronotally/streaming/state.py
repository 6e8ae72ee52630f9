"""What a checkpoint holds: windows still open, and what a restart must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.session import path_exists

_OPEN = "window_start timestamp, window_end timestamp, records bigint, partition int"


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The windows in the state of a stopped or running query, with the records they count so far; after
    ``batch``, or the last one committed. One task reads one state partition."""
    if not path_exists(spark, f"{checkpoint}/state/0"):
        return spark.createDataFrame([], _OPEN)
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("value.count").alias("records"),
        F.col("partition_id").alias("partition"),
    )


def state_partitions(spark: SparkSession, checkpoint: str) -> int | None:
    """How many partitions the state of a checkpoint has; None before the first batch."""
    if not path_exists(spark, f"{checkpoint}/state/0"):
        return None
    return spark.read.format("state-metadata").load(checkpoint).agg(F.max("numPartitions")).first()[0]


def check_restart(
    spark: SparkSession, checkpoint: str, partitions: int | None = None, size: str | None = None
) -> None:
    """Refuse to go on from a checkpoint with another number of state partitions, which Spark would put
    back without a word, or another window size, which would mix windows of both."""
    found = state_partitions(spark, checkpoint)
    if found is None:
        return
    if partitions is not None and partitions != found:
        raise ValueError(f"the checkpoint has {found} state partitions, not {partitions}")
    if size is not None:
        epoch = F.timestamp_seconds(F.lit(0))
        wanted = F.unix_seconds(epoch + F.expr(f"INTERVAL {size}"))
        length = F.unix_seconds("window_end") - F.unix_seconds("window_start")
        other = open_windows(spark, checkpoint).filter(length != wanted).select(length.alias("seconds")).first()
        if other is not None:
            raise ValueError(f"the checkpoint has windows of {other.seconds} s, not of {size}")

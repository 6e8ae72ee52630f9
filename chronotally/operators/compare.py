"""Compare a batch output with the streaming output of the same windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_parity(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """One row per column: its type on both sides and ``match``, ``type_differs``,
    ``batch_only`` or ``stream_only``."""
    spark = batch.sparkSession
    left, right = (
        spark.createDataFrame(
            [(f.name, f.dataType.simpleString()) for f in side.schema.fields],
            f"column_name string, {name} string",
        )
        for side, name in ((batch, "batch_type"), (stream, "stream_type"))
    )
    status = (
        F.when(F.col("stream_type").isNull(), "batch_only")
        .when(F.col("batch_type").isNull(), "stream_only")
        .when(F.col("batch_type") == F.col("stream_type"), "match")
        .otherwise("type_differs")
    )
    return (
        left.join(right, "column_name", "full")
        .select("column_name", "batch_type", "stream_type", status.alias("status"))
        .orderBy("column_name")
    )


def side_by_side(batch: DataFrame, stream: DataFrame, count: str = "records") -> DataFrame:
    """One row per side: windows, records in them, first and last window."""

    def totals(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.lit(side).alias("side"),
            F.count("*").alias("windows"),
            F.sum(count).alias("records"),
            F.min("window_start").alias("first_window"),
            F.max("window_start").alias("last_window"),
        )

    return totals(batch, "batch").unionByName(totals(stream, "stream"))


def reconcile_windows(batch: DataFrame, stream: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Join both sides on the window's start and end: ``match``, ``differs``, ``duplicate`` (more
    than one row for the window on a side), ``missing_in_stream`` or ``missing_in_batch``, with
    the values of both (of the largest row where there are several)."""
    window = ["window_start", "window_end"]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*window).agg(
            F.max(F.struct(*measures)).alias(name), F.count("*").alias(f"{name}_rows")
        )

    status = (
        F.when((F.col("b_rows") > 1) | (F.col("s_rows") > 1), "duplicate")
        .when(F.col("s").isNull(), "missing_in_stream")
        .when(F.col("b").isNull(), "missing_in_batch")
        .when(F.col("b").eqNullSafe(F.col("s")), "match")
        .otherwise("differs")
    )
    return side(batch, "b").join(side(stream, "s"), window, "full").select(
        *window,
        status.alias("status"),
        *[F.col(f"b.{m}").alias(f"batch_{m}") for m in measures],
        *[F.col(f"s.{m}").alias(f"stream_{m}") for m in measures],
    )

"""All roll-up outputs of a cleaned table."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronotally.functions.calendar import year_month
from chronotally.operators.reuse import kept
from chronotally.operators.rollups import breakdown, sums, with_calendar
from chronotally.session import run_folder
from chronotally.sinks.parquet import write_table
from chronotally.sources.tables import read_output
from chronotally.spec import RollupSpec

_ROWS = "_rows"
_TIME_KEYS = ("window_start", "window_end", "date", "year", "month")


def _stored_sum(column: str) -> str:
    return f"_sum_{column}"


def time_rollup(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """Counts and sums per window, split where a window touches two dates.

    Few rows (about one per hour of history), from which every output by time follows without
    another scan. Only the event time, the measures and the partition columns are read.
    """
    ts = F.col(spec.event_time)
    measures = dict.fromkeys([*spec.window_sums.values(), *spec.month_sums.values()])
    parts = {} if {"year", "month"} <= set(df.columns) else year_month(ts)
    # F.window would drop rows without a time, which still count by date and month.
    epoch = F.lit("1970-01-01").cast(df.schema[spec.event_time].dataType)
    return (
        df.withColumns({"_w": F.window(F.coalesce(ts, epoch), spec.window_size), **parts})
        .withColumns(
            {
                "window_start": F.when(ts.isNotNull(), F.col("_w.start")),
                "window_end": F.when(ts.isNotNull(), F.col("_w.end")),
                "date": F.to_date(ts),
            }
        )
        .groupBy(*_TIME_KEYS)
        .agg(F.count("*").alias(_ROWS), *sums({_stored_sum(m): m for m in measures}))
    )


def outputs_by_time(base: DataFrame, spec: RollupSpec) -> dict[str, DataFrame]:
    """The outputs that follow from :func:`time_rollup`, each in time order."""

    def regroup(rows: DataFrame, *keys: str, count: str, named: Mapping[str, str]) -> DataFrame:
        return (
            rows.groupBy(*keys)
            .agg(
                F.sum(_ROWS).alias(count),
                *sums({out: _stored_sum(column) for out, column in named.items()}),
            )
            .orderBy(*keys)
        )

    windows = regroup(
        base.filter(F.col("window_start").isNotNull()),
        "window_start",
        "window_end",
        count=spec.window_count,
        named=spec.window_sums,
    )
    months = regroup(base, "year", "month", count=spec.group_count, named=spec.month_sums)
    return {
        spec.by_window: windows.select(
            spec.window_count, *spec.window_sums, "window_start", "window_end"
        ),
        spec.by_date: regroup(base, "date", count=spec.group_count, named={}),
        spec.by_month: months.select("year", "month", spec.group_count),
        spec.sums_by_month: months.select("year", "month", *spec.month_sums, spec.group_count),
    }


def outputs_by_category(df: DataFrame, spec: RollupSpec) -> dict[str, DataFrame]:
    """One breakdown per category, each a scan of its one column."""
    return {out: breakdown(df, column, spec.group_count) for out, column in spec.categories.items()}


def write_analysis(
    df: DataFrame, event_time: str, outputs: Mapping[str, Callable[[DataFrame], DataFrame]], root: str
) -> list[str]:
    """Write several outputs made from one table with calendar columns, each to its own folder below ``root``.
    The table is read and its calendar worked out once; it is kept, in memory or on disk, until the last
    output is written."""
    with kept(with_calendar(df, event_time), len(outputs)) as frame:
        for name, make in outputs.items():
            write_table(make(frame), f"{root.rstrip('/')}/{name}")
    return list(outputs)


@dataclass(frozen=True)
class GoldRun:
    """What a run wrote, and how long it took."""

    outputs: list[str]
    elapsed_seconds: float


def write_gold(df: DataFrame, spec: RollupSpec, root: str) -> GoldRun:
    """Write every output to its own folder below ``root``; give their names and the time it took.

    Each column of the table is read once: event time and measures for all outputs by time, a
    category for its breakdown. The time roll-up is stored in the shared folder, so no output
    depends on a second scan, also when an executor is lost. Independent jobs run side by side.
    """
    spark = df.sparkSession
    staged, began = run_folder(spark, "time-rollup"), time.perf_counter()

    def write(output: tuple[str, DataFrame]) -> None:
        name, rows = output
        write_table(rows, f"{root.rstrip('/')}/{name}")

    with ThreadPoolExecutor(len(spec.outputs())) as pool:
        job = inheritable_thread_target(spark)(write)
        categories = [pool.submit(job, o) for o in outputs_by_category(df, spec).items()]
        write_table(time_rollup(df, spec), staged)
        times = outputs_by_time(read_output(spark, staged), spec)
        for done in [*categories, *[pool.submit(job, o) for o in times.items()]]:
            done.result()
    return GoldRun(spec.outputs(), time.perf_counter() - began)

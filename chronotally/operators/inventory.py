"""What is stored where: file counts and sizes per output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.sources.files import data_files, has_files

_MEGABYTE = 1024.0 * 1024.0


def _folder(spark: SparkSession, name: str, path: str) -> DataFrame:
    return data_files(spark, path).agg(
        F.lit(name).alias("name"),
        F.count("*").alias("files"),
        (F.coalesce(F.sum("length"), F.lit(0)) / _MEGABYTE).alias("megabytes"),
        (F.count("*") > 0).alias("present"),
    )


def all_present(inventory: DataFrame) -> DataFrame:
    """One row that says whether everything listed is there: ``present``, ``missing`` (names)."""
    return inventory.agg(
        F.coalesce(F.bool_and("present"), F.lit(False)).alias("present"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("present"), F.col("name")))), ", ").alias("missing"),
    )


def output_inventory(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """``name, files, megabytes, present`` for each expected output below ``root``."""
    rows = [_folder(spark, name, f"{root.rstrip('/')}/{name}") for name in names]
    return reduce(DataFrame.unionByName, rows).orderBy("name")


def run_inventory(spark: SparkSession, folders: Mapping[str, str], checkpoint: str) -> DataFrame:
    """The same columns for a streaming run: one row per named folder (replay set, arrived files,
    output) and one for the checkpoint, which counts as present when it holds any file."""
    state = spark.createDataFrame(
        [("checkpoint", None, None, has_files(spark, checkpoint))],
        "name string, files bigint, megabytes double, present boolean",
    )
    rows = [_folder(spark, name, path) for name, path in folders.items()]
    return reduce(DataFrame.unionByName, rows, state)

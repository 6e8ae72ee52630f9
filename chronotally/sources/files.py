"""File listings as DataFrames. Only names and sizes are read, never contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronotally.session import path_exists

LISTING = "path string, length bigint"


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``path``, ``length`` of the files below a folder; no rows if it does not exist."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LISTING)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def data_files(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path, "*.parquet")


def has_files(spark: SparkSession, path: str) -> bool:
    return not list_files(spark, path).isEmpty()

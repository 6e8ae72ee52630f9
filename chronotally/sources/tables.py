"""Parquet tables: the cleaned records, roll-up outputs, and a folder watched by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotally.session import path_exists
from chronotally.sources.files import data_files, has_files

_TAKEN = "path string, timestamp bigint, batchId bigint"


def read_cleaned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Cleaned records; ``year`` and ``month`` come back from the directory names as int."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a stored table, for a stream whose own folder may still be empty."""
    return spark.read.parquet(path).schema


def watch_folder(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    glob: str = "*.parquet",
    archive: str | None = None,
) -> DataFrame:
    """Stream of Parquet files as they arrive, in sub-folders too; names outside ``glob`` are left
    alone.

    ``max_files`` bounds the files of one micro-batch. Spark takes files by modification time.
    ``archive`` names a folder to which files go once a later batch has been committed, so that
    listings of the watched folder stay short.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(path)


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path, arrival, modified`` of every file a stream has taken in, by the log of its source in the
    checkpoint: whole since the first batch, and no different once files are archived or deleted. Files
    with one number of ``arrival`` were taken in by one batch."""
    log = f"{checkpoint}/sources/0"
    if not path_exists(spark, log):
        return spark.createDataFrame([], "path string, arrival bigint, modified timestamp")
    entry = F.from_json("value", _TAKEN).alias("e")
    # A compacted log repeats the entries of the logs before it.
    return (
        spark.read.text(log)
        .filter(F.col("value").startswith("{"))
        .select(entry)
        .select("e.path", F.col("e.batchId").alias("arrival"), F.timestamp_millis("e.timestamp").alias("modified"))
        .distinct()
    )


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a stored output, also one written by a stream.

    The directory is read, not a list of its files: only then does Spark honour the stream
    sink's commit log and skip files no committed batch owns.
    """
    return spark.read.parquet(path)


def read_output_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """None where nothing has been written yet."""
    if data_files(spark, path).isEmpty():
        return None
    return read_output(spark, path)


def table_status(spark: SparkSession, output: str, watched: str, checkpoint: str) -> DataFrame:
    """One row that says whether the output can be read and, if not, what is waiting.

    Columns: ``output_found``, ``files_queued`` (in the watched folder), ``checkpoint_found``.
    """
    row = (
        read_output_or_none(spark, output) is not None,
        data_files(spark, watched).count(),
        has_files(spark, checkpoint),
    )
    return spark.createDataFrame(
        [row], "output_found boolean, files_queued bigint, checkpoint_found boolean"
    )

"""Raw CSV, every column as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A quoted field that is complete, with its quotes doubled inside.
_WHOLE_QUOTED_FIELD = r'(^|,)"(?:[^"]++|"")*+"(?=,|\z)'

_FORMAT = {"header": True, "inferSchema": False, "escape": '"'}


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _ends_in_return(text: Column) -> Column:
    return F.endswith(text, F.lit("\r"))


def _irregular(text: Column) -> Column:
    """A quote is left once the complete quoted fields are taken out, or there is a carriage
    return inside, or nothing but blanks."""
    bare = F.regexp_replace(text, _WHOLE_QUOTED_FIELD, "$1")
    quotes = text.contains('"') & bare.contains('"')  # most lines have none to look at
    return quotes | text.contains("\r") | text.rlike(r"^\s+$")


def lines_are_records(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether a line-by-line scan gives what a scan of each file as a whole gives: no line is
    only a part of a record or holds blanks only, and all lines end the same way. The text is
    read once, in splits."""
    text = F.col("value")
    ends = _ends_in_return(text)
    plain = F.when(ends, F.substring(text, F.lit(1), F.length(text) - 1)).otherwise(text)
    found = (
        spark.read.option("lineSep", "\n")
        .text(_paths(path))
        .agg(
            F.bool_or(_irregular(plain)).alias("irregular"),
            F.bool_or(ends).alias("some"),
            F.bool_and(ends).alias("all"),
        )
        .first()
    )
    return not found.irregular and found.some == found.all


def read_bronze(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multi_line: bool | None = True,
    ragged: str | None = None,
) -> DataFrame:
    """Scan CSV with a header row, doubled-quote escapes and line breaks inside quotes.

    The multi-line scan takes each file as a whole: one file is one task, so deliver raw text in
    many files. ``multi_line=False`` reads files in splits and is right where no record spans
    lines; ``None`` looks at the text first, a further pass over it, and takes the scan in splits
    where it gives the same rows. ``columns`` names the columns that every file has, in order, and
    saves the job that reads the header; a file with other names in its header fails the scan.
    ``ragged`` names one more column, which holds the text of rows with fewer or more fields than there
    are columns and is NULL for all others; it needs ``columns``.
    """
    reader = spark.read.options(**_FORMAT)
    if ragged is not None:
        if columns is None:
            raise ValueError("ragged rows are only known where columns are given")
        reader = reader.option("columnNameOfCorruptRecord", ragged)
    if columns is not None:
        names = [*columns, ragged] if ragged is not None else columns
        named = T.StructType([T.StructField(c, T.StringType()) for c in names])
        reader = reader.schema(named).option("enforceSchema", False)
    if multi_line is None:
        multi_line = not lines_are_records(spark, path)
    return reader.option("multiLine", multi_line).csv(_paths(path))

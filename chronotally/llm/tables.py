"""Small helpers for frames that Python functions extend by columns."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronotally.session import run_folder


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns called like results, in any case: results replace them."""
    names = {n.lower() for n in names}
    clash = [c for c in df.columns if c.lower() in names]
    return df.drop(*clash) if clash else df


def extended(df: DataFrame, columns: dict[str, str]) -> T.StructType:
    """The schema of ``df`` with more columns, given as names and SQL types."""
    more = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in columns.items()]
    return T.StructType([*df.schema.fields, *more])


def appended(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *columns.values()], names=[*batch.schema.names, *columns]
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a new folder below ``spark.checkpoint.dir`` and read back, which cuts its
    lineage and lets several later steps read it. The folder is left to the caller's clean-up."""
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""How a query is registered."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronotally.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC times, the way SQL engines hold ``TIMESTAMP``."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants}) if instants else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` gives the same rows on the same tables."""

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            pin_utc(spark)
            return plain_times(build(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register

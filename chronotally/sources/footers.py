"""Numbers about stored tables from the footers of their files, without a scan of their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The newer reader of Parquet takes counts and extremes from footers; it is not the default.
_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}
# Types whose extremes Spark trusts a footer with: text may be cut there, times may be in an old format.
_EXTREMES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)
# What Spark says where a footer lacks them.
_NO_EXTREMES = "No min/max found"


def footer_reader(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table at ``path``, in a session of its own whose ``count``, ``min`` and ``max`` are pushed down to
    the footers where no rows are filtered and groups are folders."""
    own = spark.newSession()
    for key, value in _SETTINGS.items():
        own.conf.set(key, value)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    reader = own.read if schema is None else own.read.schema(schema)
    return reader.parquet(path)


def stored_rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """``rows_read`` of a stored table."""
    return footer_reader(spark, path, schema).agg(F.count("*").alias("rows_read"))


def stored_rows_by(
    spark: SparkSession, path: str, folders: Sequence[str], count: str = "count", schema: T.StructType | None = None
) -> DataFrame:
    """Rows of each folder of a partitioned table. ``folders`` are all of its partition columns."""
    return footer_reader(spark, path, schema).groupBy(*folders).agg(F.count("*").alias(count))


def stored_extremes(
    spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """``column, least, greatest, values``: extremes of number, date and boolean columns, as text, and how
    many values are not NULL.

    The footers are read at once. A part of a file without a single value of a column has no extremes there;
    with such a part those columns are scanned.
    """
    table = footer_reader(spark, path, schema)
    other = [c for c in columns if not isinstance(table.schema[c].dataType, _EXTREMES)]
    if other:
        raise ValueError(f"footers tell no extremes of {other}")
    def found(rows: DataFrame) -> list[tuple]:
        wanted = [f(c) for c in columns for f in (F.min, F.max, F.count)]
        numbers = rows.agg(*wanted).toDF(*map(str, range(len(wanted))))
        row = numbers.select(*[F.col(c).cast("string") for c in numbers.columns]).first()
        return [(c, row[3 * i], row[3 * i + 1], int(row[3 * i + 2])) for i, c in enumerate(columns)]

    try:
        rows = found(table)
    except Exception as error:
        if _NO_EXTREMES not in str(error):
            raise
        rows = found((spark.read if schema is None else spark.read.schema(schema)).parquet(path))
    return spark.createDataFrame(rows, "column string, least string, greatest string, values bigint")


def stored_summary(
    spark: SparkSession, path: str, event_time: str, schema: T.StructType | None = None
) -> DataFrame:
    """First and last event time and the row count of a table in ``year`` and ``month`` folders.

    Rows are counted from the footers, month by month; only the files of the first and the last month
    are read, and of those only the event time.
    """
    months = stored_rows_by(spark, path, ["year", "month"], "rows", schema)
    number = F.col("year") * 12 + F.col("month")
    known = months.agg(F.min(number).alias("low"), F.max(number).alias("high"), F.sum("rows").alias("rows")).first()
    reader = spark.read if schema is None else spark.read.schema(schema)
    # One row of bounds is known now, so the folders in between are not even listed for the scan.
    edges = reader.parquet(path).filter(number.isin(known.low, known.high) if known.rows else F.lit(False))
    return edges.agg(
        F.min(event_time).alias("first_event"),
        F.max(event_time).alias("last_event"),
        F.lit(known.rows or 0).cast("bigint").alias("rows_processed"),
    )

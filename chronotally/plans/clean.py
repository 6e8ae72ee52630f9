"""Raw text records to the typed, partitioned table."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chronotally.functions.casts import lenient_int, parse_time
from chronotally.functions.calendar import year_month
from chronotally.operators.checks import columns_required
from chronotally.session import child_names, path_exists, remove_folder
from chronotally.sinks.parquet import spread_by, write_partitioned
from chronotally.spec import RecordSpec

_RAGGED = "_ragged_row"


@dataclass(frozen=True)
class CleanCounts:
    """What one cleaning run did with its rows."""

    rows_in: int
    dropped_bad_time: int
    dropped_out_of_scope: int
    rows_out: int
    #: Rows with fewer or more fields than columns, kept or not; None where the scan does not tell.
    ragged: int | None = None


def typed_records(raw: DataFrame, spec: RecordSpec, more: Sequence[str] = ()) -> DataFrame:
    """Keep the wanted columns (and ``more`` as they are), type them, add ``year`` and ``month``. No row is
    dropped."""
    typed = {c: lenient_int(F.col(c)) for c in spec.integers}
    typed[spec.event_time] = parse_time(F.col(spec.event_time), spec.time_format)
    return (
        columns_required(raw, [*spec.columns, *more])
        .withColumns(typed)
        .withColumns(year_month(F.col(spec.event_time)))
    )


def clean(raw: DataFrame, spec: RecordSpec) -> DataFrame:
    """Records with a readable time in the years in scope.

    Spark moves the filter below the parsing and parses again for each mention of the time, so
    the years are a list, which is one mention and leaves out unreadable times as well.
    """
    return typed_records(raw, spec).filter(
        F.col("year").isin(*range(spec.first_year, spec.last_year + 1))
    )


def _in_scope(spec: RecordSpec) -> Column:
    return F.coalesce(F.col("year").between(spec.first_year, spec.last_year), F.lit(False))


def _in_months(months: Collection[tuple[int, int]]) -> Column:
    return (F.col("year") * 12 + F.col("month")).isin(*[year * 12 + month for year, month in months])


def stored_folders(spark: SparkSession, path: str, months: Collection[tuple[int, int]]) -> dict[str, list[str]]:
    """The names of the files in the folder of each month."""
    folders = [f"{path}/year={year}/month={month}" for year, month in months]
    return {f: sorted(child_names(spark, f)) if path_exists(spark, f) else [] for f in folders}


def write_clean(
    raw: DataFrame,
    spec: RecordSpec,
    path: str,
    mode: str = "overwrite",
    time_order: bool = False,
    ragged: str | None = None,
    months: Collection[tuple[int, int]] | None = None,
) -> CleanCounts:
    """Clean and store in one pass over the raw text, counting the dropped rows on the way.

    The counts are taken behind the shuffle, in the stage that writes: Spark adds the counts of
    a task of that last stage once, however often an executor is lost, while those of an
    earlier stage would be added again. Rows to be dropped travel there as two small flags
    with every column NULL. ``time_order`` sorts the rows of each file by event time. ``ragged`` names
    the column in which the scan marks rows with too few or too many fields, to count them.

    With ``months`` (pairs of year and month) only those are cleaned again: the rows of ``raw`` in them
    take the place of what is stored, rows outside count as out of scope, and the files of all other
    months are left as they are. A month that has no rows any more is removed.
    """
    odd_row = F.lit(False) if ragged is None else F.col(ragged).isNotNull()
    records = typed_records(raw.withColumn(_RAGGED, odd_row), spec, [_RAGGED])
    columns = [c for c in records.columns if c != _RAGGED]
    kept, timed, odd = F.col("_kept"), F.col("_timed"), F.col(_RAGGED)
    wanted = _in_scope(spec) if months is None else _in_scope(spec) & _in_months(months)
    marked = records.withColumns(
        {"_kept": F.coalesce(wanted, F.lit(False)), "_timed": F.col(spec.event_time).isNotNull()}
    ).select("_kept", "_timed", _RAGGED, *[F.when(kept, F.col(c)).alias(c) for c in columns])

    seen = Observation()
    counted = spread_by(marked, ["year", "month"]).observe(
        seen,
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~timed).alias("dropped_bad_time"),
        F.count_if(timed & ~kept).alias("dropped_out_of_scope"),
        F.count_if(kept).alias("rows_out"),
        F.count_if(odd).alias("ragged"),
    )
    write_partitioned(
        counted.filter(kept).select(*columns),
        path,
        ["year", "month"],
        order_within=[spec.event_time] if time_order else (),
        mode=mode,
        spread=False,
        only_written=months is not None,
    )
    found = dict(seen.get)
    return CleanCounts(**{**found, "ragged": found["ragged"] if ragged else None})


def reclean_months(
    raw: DataFrame,
    spec: RecordSpec,
    path: str,
    months: Collection[tuple[int, int]],
    ragged: str | None = None,
) -> CleanCounts:
    """Clean some months of a stored table again, see :func:`write_clean`."""
    spark = raw.sparkSession
    if not months:
        raise ValueError("no months given")
    began = stored_folders(spark, path, months)
    counts = write_clean(raw, spec, path, ragged=ragged, months=months)
    # The writer replaces folders that get rows; one that gets none still holds the old ones.
    for folder, files in stored_folders(spark, path, months).items():
        if files and files == began.get(folder):
            remove_folder(spark, folder)
    return counts

"""Raw CSV to the partitioned table, and the outputs written from it."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally import operators as op
from chronotally import plans
from chronotally.functions import lenient_int, parse_time
from chronotally.registry.base import query
from chronotally.registry.tables import (
    LONG_SQL,
    ORDER_RECORDS,
    ORDER_ROLLUPS,
    RAW_SQL,
    SHORT_SQL,
    TEXT_TIME,
    ragged_csv,
    raw_csv,
    raw_orders,
    table,
)
from chronotally.session import run_folder
from chronotally.sinks import write_table
from chronotally.sources import (
    data_files,
    read_bronze,
    read_cleaned,
    read_output,
    stored_extremes,
    stored_rows,
    stored_rows_by,
    stored_summary,
)
from chronotally.streaming import write_replay


def _written(spark: SparkSession, folder: str, label: str) -> tuple[str, plans.CleanCounts]:
    """Write the cleaned table from CSV."""
    raw = read_bronze(spark, raw_csv(spark, folder, f"{label}-csv"), multi_line=False)
    path = run_folder(spark, f"{label}-clean")
    return path, plans.write_clean(raw, ORDER_RECORDS, path)


def _stored(spark: SparkSession, folder: str, label: str) -> tuple[DataFrame, plans.CleanCounts]:
    """The cleaned table read back with its explicit schema."""
    path, counts = _written(spark, folder, label)
    return read_cleaned(spark, path, ORDER_RECORDS.schema()), counts


# The scan gives NULL for an empty field, quoted or not.
_SCANNED_SQL = "(select * replace (nullif(happened, '') as happened) from raw)"


@query("csv_line_scan", f"with {RAW_SQL} select * exclude (note) from {_SCANNED_SQL}")
def csv_line_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The scan in splits, by given columns, of text in which no record spans lines."""
    columns = ["record_id", "happened", "people", "serious", "status", "priority"]
    return read_bronze(spark, raw_csv(spark, folder, "lines"), columns, multi_line=False)


@query("csv_bronze_scan", f"with {RAW_SQL} select * from {_SCANNED_SQL}")
def csv_bronze_scan(spark: SparkSession, folder: str) -> DataFrame:
    return read_bronze(spark, raw_csv(spark, folder, "scan", notes=True))


@query(
    "canonical_select",
    f"""with {RAW_SQL}
    select record_id, happened, people, serious, status, priority from {_SCANNED_SQL}""",
)
def canonical_select(spark: SparkSession, folder: str) -> DataFrame:
    raw = read_bronze(spark, raw_csv(spark, folder, "select", notes=True))
    return op.columns_required(raw, ORDER_RECORDS.columns)


@query(
    "parse_event_time",
    f"with {RAW_SQL} select record_id, t.happened as parsed from typed t",
)
def parse_event_time(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_orders(spark, folder)
    return raw.select("record_id", parse_time(F.col("happened"), TEXT_TIME).alias("parsed"))


@query("lenient_int_cast", f"with {RAW_SQL} select record_id, people, serious from typed")
def lenient_int_cast(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_orders(spark, folder)
    return raw.select(
        "record_id", *[lenient_int(F.col(c)).alias(c) for c in ORDER_RECORDS.integers]
    )


@query("bronze_to_silver", f"with {RAW_SQL} select * from silver")
def bronze_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    return plans.clean(read_bronze(spark, raw_csv(spark, folder, "clean")), ORDER_RECORDS)


@query(
    "etl_drop_counts",
    f"""with {RAW_SQL}
    select count(*) as rows_in,
      count(*) filter (happened is null) as dropped_bad_time,
      count(*) filter (year not between 1996 and 1999) as dropped_out_of_scope,
      count(*) filter (year between 1996 and 1999) as rows_out,
      (select count(*) from orders where {SHORT_SQL} or {LONG_SQL}) as ragged
    from dated""",
)
def etl_drop_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows dropped, and rows with too few or too many fields, which are padded or cut."""
    path = ragged_csv(spark, folder, "counts-csv")
    raw = read_bronze(spark, path, ORDER_RECORDS.columns, multi_line=False, ragged="odd")
    counts = plans.write_clean(raw, ORDER_RECORDS, run_folder(spark, "counts-clean"), ragged="odd")
    names = ("rows_in", "dropped_bad_time", "dropped_out_of_scope", "rows_out", "ragged")
    return spark.createDataFrame(
        [tuple(getattr(counts, n) for n in names)], ", ".join(f"{n} bigint" for n in names)
    )


@query(
    "ragged_rows_padded",
    f"""with {RAW_SQL} select s.* replace (case when {SHORT_SQL} then null else s.priority end as priority)
    from silver s join orders on s.record_id = cast(o_orderkey as varchar)""",
)
def ragged_rows_padded(spark: SparkSession, folder: str) -> DataFrame:
    """Short rows end in NULL, what is too much of long ones is cut."""
    path = ragged_csv(spark, folder, "ragged-csv")
    return plans.clean(
        read_bronze(spark, path, ORDER_RECORDS.columns, multi_line=False, ragged="odd"), ORDER_RECORDS
    )


# One month is delivered again with every other record, one with none.
_AGAIN, _GONE = (1997, 5), (1998, 2)


@query(
    "month_cleaned_again",
    f"""with {RAW_SQL}
    select year, month, count(*) as n, not (year = 1997 and month = 5) as files_left_alone from silver
    where not (year = 1997 and month = 5 and cast(record_id as bigint) % 2 = 1)
      and not (year = 1998 and month = 2)
    group by 1, 2""",
)
def month_cleaned_again(spark: SparkSession, folder: str) -> DataFrame:
    """Two months are cleaned again; the files of the others are those of the first run."""
    path, _ = _written(spark, folder, "again")
    listed = run_folder(spark, "again-files")
    data_files(spark, path).select(F.col("path").alias("old")).write.parquet(listed)
    typed = F.year("happened_at") * 12 + F.month("happened_at")
    raw = raw_orders(spark, folder).withColumn("happened_at", parse_time(F.col("happened"), TEXT_TIME))
    odd = F.col("record_id").cast("bigint") % 2 == 1
    again, gone = (F.coalesce(typed == y * 12 + m, F.lit(False)) for y, m in (_AGAIN, _GONE))
    plans.reclean_months(raw.filter(~(again & odd) & ~gone), ORDER_RECORDS, path, [_AGAIN, _GONE])
    old = spark.read.parquet(listed)
    part = [F.regexp_extract("path", rf"/{p}=(\d+)/", 1).cast("int").alias(p) for p in ("year", "month")]
    left = (
        data_files(spark, path)
        .join(old, F.col("path") == F.col("old"), "left")
        .groupBy(*part)
        .agg(F.bool_and(F.col("old").isNotNull()).alias("files_left_alone"))
    )
    rows = read_cleaned(spark, path, ORDER_RECORDS.schema()).groupBy("year", "month").agg(F.count("*").alias("n"))
    return rows.join(left, ["year", "month"])


@query("silver_write_readback", f"with {RAW_SQL} select * from silver")
def silver_write_readback(spark: SparkSession, folder: str) -> DataFrame:
    return _stored(spark, folder, "readback")[0]


@query(
    "check_silver_readback",
    f"""with {RAW_SQL}
    select 'read-back row count equals rows written' as "check", true as passed,
      cast(0 as bigint) as n_bad,
      count(*) || ' of ' || count(*) || ' rows' as detail
    from silver""",
)
def check_silver_readback(spark: SparkSession, folder: str) -> DataFrame:
    path, counts = _written(spark, folder, "readback-check")
    return op.rows_read_check(stored_rows(spark, path), counts.rows_out)


@query(
    "silver_rows_by_month",
    f"with {RAW_SQL} select year, month, count(*) as n from silver group by 1, 2",
)
def silver_rows_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each folder, from the footers of its files."""
    path, _ = _written(spark, folder, "footers")
    return stored_rows_by(spark, path, ["year", "month"], "n")


@query(
    "silver_summary",
    f"""with {RAW_SQL} select min(happened) as first_event, max(happened) as last_event,
      count(*) as rows_processed from silver""",
)
def silver_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Rows from the footers, first and last event time from the first and the last month alone."""
    path, _ = _written(spark, folder, "summary")
    return stored_summary(spark, path, "happened", ORDER_RECORDS.schema())


@query(
    "stored_extremes",
    " union all ".join(
        f"""select '{c}' as "column", cast(min({c}) as varchar) as least, cast(max({c}) as varchar) as greatest,
        count({c}) as values from lineitem"""
        for c in ("l_orderkey", "l_linenumber", "l_quantity")
    ),
)
def extremes_of_line_items(spark: SparkSession, folder: str) -> DataFrame:
    """Least and greatest of number columns, from the footers."""
    return stored_extremes(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"])


@query(
    "silver_scan_pruned",
    f"with {RAW_SQL} select * from silver where year = 1997 and month between 3 and 8",
)
def silver_scan_pruned(spark: SparkSession, folder: str) -> DataFrame:
    stored, _ = _stored(spark, folder, "pruned")
    return op.years_between(stored, 1997, 1997).filter(F.col("month").between(3, 8))


@query(
    "check_years_in_scope",
    f"""with {RAW_SQL}
    select 'years within 1996-1999' as "check", count(*) filter (not ok) = 0 as passed,
      count(*) filter (not ok) as n_bad, count(*) filter (not ok) || ' of ' || count(*) || ' rows' as detail,
      'stored' as side
    from (select coalesce(year between 1996 and 1999, false) as ok from silver)
    union all
    select 'years within 1996-1999', count(*) filter (not ok) = 0, count(*) filter (not ok),
      count(*) filter (not ok) || ' of ' || count(*) || ' rows', 'unfiltered'
    from (select coalesce(year between 1996 and 1999, false) as ok from dated)""",
)
def check_years_in_scope(spark: SparkSession, folder: str) -> DataFrame:
    """The stored table passes; the same records before the filter do not."""
    stored, _ = _stored(spark, folder, "scope")
    sides = {"stored": stored, "unfiltered": plans.typed_records(raw_orders(spark, folder), ORDER_RECORDS)}
    checks = [
        op.years_in_scope_check(df, 1996, 1999).withColumn("side", F.lit(side))
        for side, df in sides.items()
    ]
    return checks[0].unionByName(checks[1])


# --- all outputs of one table ---------------------------------------------------------------

_GOLD_SQL = f"""
with {RAW_SQL},
months as (
  select year, month, count(*) as n, cast(sum(people) as bigint) as people_total,
    cast(sum(serious) as bigint) as serious_total
  from silver group by 1, 2
)
select 'orders_by_hour_window' as output,
  strftime(time_bucket(interval '1 hour', happened), '%Y-%m-%d %H:%M:%S') as bucket,
  count(*) as n, cast(sum(people) as bigint) as people_total,
  cast(sum(serious) as bigint) as serious_total
from silver group by 2
union all
select 'orders_by_date', strftime(happened, '%Y-%m-%d'), count(*), null, null
from silver group by 2
union all select 'orders_by_month', year || '-' || month, n, null, null from months
union all select 'people_by_month', year || '-' || month, n, people_total, serious_total from months
union all select 'orders_by_priority', priority, count(*), null, null from silver group by 2
union all select 'orders_by_status', status, count(*), null, null from silver group by 2"""


@query("gold_readback", _GOLD_SQL)
def gold_readback(spark: SparkSession, folder: str) -> DataFrame:
    """Every output, read back from its own folder and put in one shape."""
    stored, _ = _stored(spark, folder, "gold")
    root = run_folder(spark, "gold")
    plans.write_gold(stored, ORDER_ROLLUPS, root)
    month = F.concat_ws("-", "year", "month")
    shapes = {
        "orders_by_hour_window": (
            F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), "orders", True,
        ),
        "orders_by_date": (F.date_format("date", "yyyy-MM-dd"), "order_count", False),
        "orders_by_month": (month, "order_count", False),
        "people_by_month": (month, "order_count", True),
        "orders_by_priority": (F.col("priority"), "order_count", False),
        "orders_by_status": (F.col("status"), "order_count", False),
    }
    nothing = F.lit(None).cast("bigint")
    parts = [
        read_output(spark, f"{root}/{name}").select(
            F.lit(name).alias("output"),
            bucket.alias("bucket"),
            F.col(count).alias("n"),
            *[(F.col(m) if summed else nothing).alias(m) for m in ORDER_ROLLUPS.month_sums],
        )
        for name, (bucket, count, summed) in shapes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "shared_frame_outputs",
    """select 'by_weekday' as output, dayname(o_orderdate) as bucket, count(*) as n from orders group by 2
    union all select 'by_week', cast(weekofyear(o_orderdate) as varchar), count(*) from orders group by 2
    union all select 'by_date', cast(cast(o_orderdate as date) as varchar), count(*) from orders group by 2""",
)
def shared_frame_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Three outputs of one table with calendar columns, which is worked out once."""
    keys = {"by_weekday": "day_of_week", "by_week": "week_of_year", "by_date": "date"}

    def counts(key: str):
        return lambda df: df.groupBy(F.col(key).cast("string").alias("bucket")).agg(F.count("*").alias("n"))

    root = run_folder(spark, "analysis")
    orders = table(spark, folder, "orders").select("o_orderdate")
    names = plans.write_analysis(orders, "o_orderdate", {name: counts(key) for name, key in keys.items()}, root)
    return reduce(
        DataFrame.unionByName,
        [read_output(spark, f"{root}/{name}").withColumn("output", F.lit(name)) for name in names],
    )


def _names_and_all(inventory: DataFrame) -> DataFrame:
    """What is there by name, and the conclusion; counts and sizes of files depend on the cluster."""
    whole = op.all_present(inventory).select(
        F.concat(F.lit("all, missing: "), "missing").alias("name"), "present"
    )
    return inventory.select("name", "present").unionByName(whole)


@query(
    "output_inventory",
    f"""with {RAW_SQL},
    named as (
      select * from (values ('orders_by_hour_window'), ('orders_by_date'), ('orders_by_month'),
        ('people_by_month'), ('orders_by_priority'), ('orders_by_status')) t(name)
    )
    select name, (select count(*) > 0 from silver) as present from named
    union all values ('not_written', false), ('all, missing: not_written', false)""",
)
def output_inventory(spark: SparkSession, folder: str) -> DataFrame:
    stored, _ = _stored(spark, folder, "inventory")
    root = run_folder(spark, "inventory-gold")
    run = plans.write_gold(stored, ORDER_ROLLUPS, root)
    return _names_and_all(op.output_inventory(spark, root, [*run.outputs, "not_written"]))


@query(
    "timed_run_summary",
    f"""with {RAW_SQL}
    select min(happened) as first_event, max(happened) as last_event, count(*) as rows_processed,
      'orders_by_hour_window, orders_by_date, orders_by_month, people_by_month, orders_by_priority, orders_by_status'
        as outputs,
      true as timed
    from silver""",
)
def timed_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """A batch run from the cleaned table to all outputs, with the time it took."""
    path, _ = _written(spark, folder, "timed")
    schema = ORDER_RECORDS.schema()
    run = plans.write_gold(read_cleaned(spark, path, schema), ORDER_ROLLUPS, run_folder(spark, "timed-gold"))
    summary = op.with_run(stored_summary(spark, path, "happened", schema), run.elapsed_seconds, run.outputs)
    return summary.withColumns(
        {"outputs": F.array_join("outputs", ", "), "timed": F.col("elapsed_seconds") > 0}
    ).drop("elapsed_seconds")


@query(
    "missing_columns",
    """select 'people' as name, count(*) as rows_in from orders
    union all select 'serious', count(*) from orders""",
)
def missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    """The columns that the check for required columns names, over a table that lacks them."""
    raw = read_bronze(spark, raw_csv(spark, folder, "missing")).drop("people", "serious")
    try:
        op.columns_required(raw, ORDER_RECORDS.columns)
        named = []
    except ValueError as error:
        named = [c for c in ORDER_RECORDS.columns if f"'{c}'" in str(error)]
    return raw.agg(F.count("*").alias("rows_in")).select(
        F.explode(F.array(*map(F.lit, named))).alias("name"), "rows_in"
    )


@query(
    "save_mode_kept",
    """select o_orderpriority as priority, count(*) as n, true as refused from orders group by 1""",
)
def save_mode_kept(spark: SparkSession, folder: str) -> DataFrame:
    """A second write to the same place is refused and leaves the first one as it was."""
    counts = op.breakdown(raw_orders(spark, folder), "priority", "n")
    path = run_folder(spark, "kept")
    write_table(counts, path, "errorifexists")
    try:
        write_table(counts.limit(1), path, "errorifexists")
        refused = False
    except AnalysisException:
        refused = True
    return read_output(spark, path).withColumn("refused", F.lit(refused))


# --- replay sets ----------------------------------------------------------------------------


def _replayed(spark: SparkSession, folder: str, chunking: str) -> DataFrame:
    stored, _ = _stored(spark, folder, f"replay-{chunking}")
    path = run_folder(spark, f"replay-{chunking}")
    write_replay(stored, "happened", path, chunking)
    return (
        read_output(spark, path)
        .groupBy("chunk_key")
        .agg(
            F.count("*").alias("n"),
            F.min("happened").alias("first_event"),
            F.max("happened").alias("last_event"),
            F.sum("people").alias("people_total"),
        )
    )


def _replay_sql(key: str) -> str:
    return f"""with {RAW_SQL}
    select cast({key} as date) as chunk_key, count(*) as n, min(happened) as first_event,
      max(happened) as last_event, cast(sum(people) as bigint) as people_total
    from silver group by 1"""


@query("replay_chunks_day", _replay_sql("happened"))
def replay_chunks_day(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, "day")


@query("replay_chunks_week", _replay_sql("date_trunc('week', happened)"))
def replay_chunks_week(spark: SparkSession, folder: str) -> DataFrame:
    return _replayed(spark, folder, "week")

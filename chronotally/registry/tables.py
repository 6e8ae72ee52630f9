"""The given tables seen as timestamped records, and the same views in SQL."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotally.session import run_folder
from chronotally.spec import RecordSpec, RollupSpec

TEXT_TIME = "MM/dd/yyyy hh:mm:ss a"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- events: hour windows, days, streams. k is the measure, error_k its subset. -------------

EVENT_SUMS = {"k_total": "k", "error_k_total": "error_k"}

EVENTS_SQL = """
e as (
  select event_id, ts, event_type, k, case when event_type = 'error' then k end as error_k
  from (select *, try_cast(json_extract_string(props, '$.k') as integer) as k from events)
)"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    return (
        table(spark, folder, "events")
        .select("event_id", "ts", "event_type", k.alias("k"))
        .withColumn("error_k", F.when(F.col("event_type") == "error", F.col("k")))
    )


def event_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Events with instants: a watermark does not take zone-less times."""
    return events(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))


# --- orders: several years, months, raw text to clean. --------------------------------------

ORDER_SUMS = {"people_total": "people", "serious_total": "serious"}

ORDER_RECORDS = RecordSpec(
    columns=("record_id", "happened", "people", "serious", "status", "priority"),
    event_time="happened",
    time_format=TEXT_TIME,
    integers=("people", "serious"),
    first_year=1996,
    last_year=1999,
)

ORDER_ROLLUPS = RollupSpec(
    event_time="happened",
    window_sums=ORDER_SUMS,
    month_sums=ORDER_SUMS,
    categories={"orders_by_priority": "priority", "orders_by_status": "status"},
    window_count="orders",
    group_count="order_count",
    by_window="orders_by_hour_window",
    by_date="orders_by_date",
    by_month="orders_by_month",
    sums_by_month="people_by_month",
)

# Orders as raw text: a time at a second of its day, unreadable for some; numbers in the shapes
# a lenient cast must deal with; a note with quotes, commas and a line break.
RAW_SQL = r"""
timed as (
  select *, o_orderdate + to_seconds(o_orderkey % 86400) as ts from orders
),
raw as (
  select
    cast(o_orderkey as varchar) as record_id,
    case
      when o_orderstatus = 'P' and o_orderpriority = '5-LOW' then strftime(ts, '%Y-%m-%d')
      when o_orderstatus = 'P' and o_orderpriority = '2-HIGH' then ''
      else strftime(ts, '%m/%d/%Y %I:%M:%S %p')
    end as happened,
    case o_orderpriority
      when '1-URGENT' then o_custkey || '.5'
      when '2-HIGH' then '  ' || o_custkey || ' '
      when '3-MEDIUM' then cast(o_custkey as varchar)
      when '4-NOT SPECIFIED' then 'n/a'
      else '99999999999'
    end as people,
    case when o_orderstatus = 'F' then cast(o_custkey % 3 as varchar) end as serious,
    o_orderstatus as status,
    o_orderpriority as priority,
    case when o_orderstatus = 'F'
      then 'said "' || o_orderpriority || '", then' || chr(10) || 'left order ' || o_orderkey
      else o_orderpriority
    end as note
  from timed
),
typed as (
  select
    cast(o_orderkey as varchar) as record_id,
    case when o_orderstatus = 'P' and o_orderpriority in ('5-LOW', '2-HIGH') then null
      else ts end as happened,
    case when o_orderpriority in ('1-URGENT', '2-HIGH', '3-MEDIUM')
      then cast(o_custkey as integer) end as people,
    case when o_orderstatus = 'F' then cast(o_custkey % 3 as integer) end as serious,
    o_orderstatus as status,
    o_orderpriority as priority
  from timed
),
dated as (
  select *, cast(year(happened) as integer) as year, cast(month(happened) as integer) as month
  from typed
),
silver as (select * from dated where year between 1996 and 1999)"""


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.timestamp_add("SECOND", F.col("o_orderkey") % 86400, F.col("o_orderdate"))
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    customer = F.col("o_custkey").cast("string")
    happened = (
        F.when((status == "P") & (priority == "5-LOW"), F.date_format(ts, "yyyy-MM-dd"))
        .when((status == "P") & (priority == "2-HIGH"), "")
        .otherwise(F.date_format(ts, TEXT_TIME))
    )
    people = (
        F.when(priority == "1-URGENT", F.concat(customer, F.lit(".5")))
        .when(priority == "2-HIGH", F.concat(F.lit("  "), customer, F.lit(" ")))
        .when(priority == "3-MEDIUM", customer)
        .when(priority == "4-NOT SPECIFIED", "n/a")
        .otherwise("99999999999")
    )
    serious = F.when(status == "F", (F.col("o_custkey") % 3).cast("string"))
    note = F.when(
        status == "F",
        F.concat(F.lit('said "'), priority, F.lit('", then\nleft order '), F.col("o_orderkey")),
    ).otherwise(priority)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("record_id"),
        happened.alias("happened"),
        people.alias("people"),
        serious.alias("serious"),
        status.alias("status"),
        priority.alias("priority"),
        note.alias("note"),
    )


def write_csv(df: DataFrame, label: str) -> str:
    """Store as quoted CSV with a header and return the folder."""
    path = run_folder(df.sparkSession, label)
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def raw_csv(spark: SparkSession, folder: str, label: str, notes: bool = False) -> str:
    """Raw orders as CSV. The notes hold line breaks and make the scan a multi-line one."""
    rows = raw_orders(spark, folder)
    return write_csv(rows if notes else rows.drop("note"), label)


# Rows of the ragged file that lack their last field or have one too many.
SHORT_SQL, LONG_SQL = "o_orderkey % 7 = 3", "o_orderkey % 11 = 5"


def ragged_csv(spark: SparkSession, folder: str, label: str) -> str:
    """Raw orders as CSV in which some rows have another number of fields than the header."""
    columns = list(ORDER_RECORDS.columns)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in columns]
    key = F.col("record_id").cast("bigint")
    line = (
        F.when(key % 7 == 3, F.concat_ws(",", *fields[:-1]))
        .when(key % 11 == 5, F.concat_ws(",", *fields, F.lit("one more")))
        .otherwise(F.concat_ws(",", *fields))
    )

    def with_header(batches):
        yield pa.RecordBatch.from_pydict({"value": [",".join(columns)]})
        for batch in batches:
            yield pa.RecordBatch.from_arrays(batch.columns, names=["value"])

    path = run_folder(spark, label)
    raw_orders(spark, folder).select(line.alias("value")).mapInArrow(with_header, "value string").write.text(path)
    return path


# --- line items: the largest table. ---------------------------------------------------------


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").withColumn(
        "quantity", F.floor("l_quantity").cast("bigint")
    )

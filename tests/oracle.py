"""Run registered queries next to their SQL: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


# How an engine's type is written by the other.
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, name: str, folder: str) -> list[str]:
    """What differs; nothing when the query agrees with its SQL (or has none and gives rows)."""
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, folder)
    got = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return [] if got else ["no rows"]
    rel = con.execute(sql)
    columns = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    want = rel.fetchall()
    problems = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    relation = con.sql(sql)
    types = dict(zip(relation.columns, map(str, relation.types)))
    for field in df.schema.fields:
        if _TYPES.get(field.dataType.simpleString()) != types[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} / {types[field.name]}")
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if a != b:
        problems.append(
            f"rows {sum(a.values())} / {sum(b.values())}; only Spark {list((a - b).items())[:2]}; "
            f"only SQL {list((b - a).items())[:2]}"
        )
    if not want:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    from chronotally.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "oracle",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    import __spark_entry__ as entry

    names = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in names:
        begun = time.time()
        try:
            problems = compare(session, con, name, folder)
        except Exception as error:  # report and go on
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - begun:.1f}s", *problems, sep="\n      " if problems else " ", flush=True)
    print(f"{len(names)} queries, {bad} bad, {len(entry.oracle_sql())} with SQL")

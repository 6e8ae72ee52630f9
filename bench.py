"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores (default 8).
Queries and the replay are run three times and the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from chronotally import plans
from chronotally.registry import QUERIES
from chronotally.registry.streams import _replay
from chronotally.registry.tables import ORDER_RECORDS, ORDER_ROLLUPS, event_instants, raw_csv
from chronotally.session import build_session, run_folder
from chronotally.sources import read_bronze, read_cleaned
from chronotally.streaming import progress_frame, time_to_first_window

BATCH = [
    "hourly_windows",
    "hourly_series_slice",
    "preview_first_windows",
    "calendar_features",
    "counts_by_date",
    "counts_by_week",
    "counts_by_month",
    "counts_by_month_and_category",
    "measures_by_month",
    "monthly_series_labeled",
    "breakdown_by_category",
    "breakdown_by_event_type",
    "rows_by_year",
    "distinct_years",
    "run_summary",
    "parse_event_time",
    "lenient_int_cast",
    "check_overall",
]


def timed(work) -> float:
    begun = time.perf_counter()
    work()
    return time.perf_counter() - begun


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    run("hourly_windows")  # start-up of the JVM is not a query
    seconds = {name: statistics.median(timed(lambda: run(name)) for _ in range(3)) for name in BATCH}

    # The batch path as a whole: raw text to the clean table, then all outputs from it.
    raw = raw_csv(spark, folder, "bench-csv")
    noted = raw_csv(spark, folder, "bench-noted", notes=True)
    seconds["csv_multi_line_scan"] = timed(
        lambda: read_bronze(spark, noted).write.format("noop").mode("overwrite").save()
    )
    clean, gold = run_folder(spark, "bench-clean"), run_folder(spark, "bench-gold")
    counts = []
    seconds["clean_write"] = timed(
        lambda: counts.append(plans.write_clean(read_bronze(spark, raw, multi_line=False), ORDER_RECORDS, clean))
    )
    stored = read_cleaned(spark, clean, ORDER_RECORDS.schema())
    seconds["all_outputs_write"] = timed(lambda: plans.write_gold(stored, ORDER_ROLLUPS, gold))

    # The stream: five weekly arrivals, one query that runs all the while.
    runs = []
    again = [
        timed(lambda: runs.append(_replay(spark, event_instants(spark, folder), "bench-stream")))
        for _ in range(3)
    ]
    seconds["stream_replay"] = statistics.median(again)
    log = runs[-1].log
    progress = progress_frame(log).agg(F.sum("input_rows").alias("rows"), F.sum("duration_ms").alias("ms")).first()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "stream_first_window_sec": round(time_to_first_window(log), 3),
                "stream_rows_per_sec": round(progress.rows * 1000 / progress.ms),
                "clean_rows_per_sec": round(counts[0].rows_in / seconds["clean_write"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

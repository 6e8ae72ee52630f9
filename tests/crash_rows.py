"""Small crash records, raw and cleaned, with the awkward cases."""

from __future__ import annotations

import csv
from datetime import datetime

from chronotally.spec import CRASH_RECORDS

COLUMNS = list(CRASH_RECORDS.columns)

GOOD_TIME = "01/05/2022 08:30:00 PM"
BAD_TIMES = [
    "",
    "2022-01-05",
    "02/30/2022 01:00:00 AM",
    "13/05/2022 08:30:00 PM",
    "1/5/2022 8:30:00 PM",
    "01/05/2022 20:30:00",
]


def raw(record_id, happened=GOOD_TIME, total="1", fatal="0", cause="SPEED", weather="CLEAR"):
    return [record_id, happened, total, fatal, "NONE", weather, "DAYLIGHT", "DRY", cause, "NONE"]


RAW_ROWS = [
    raw("ok"),
    raw("lower", "01/05/2022 08:30:00 pm", "0"),
    raw("midnight", "01/01/2022 12:00:00 AM", "0"),
    raw("last_second", "12/31/2025 11:59:59 PM", "0"),
    raw("early", "12/31/2021 12:00:00 AM"),
    raw("late", "01/01/2026 12:00:00 AM"),
    *[raw(f"bad_time_{i}", t) for i, t in enumerate(BAD_TIMES)],
    raw("empty_int", total=""),
    raw("word_int", total="abc"),
    raw("huge_int", total="99999999999"),
    raw("fraction", total="1.5"),
    raw("spaces", total=" 3 "),
    raw("quoting", cause='FAILED, "YIELD"\nTO RIGHT'),
]

# record_id -> (event time, INJURIES_TOTAL) of the rows that are kept
CLEAN = {
    "ok": (datetime(2022, 1, 5, 20, 30), 1),
    "lower": (datetime(2022, 1, 5, 20, 30), 0),
    "midnight": (datetime(2022, 1, 1, 0, 0), 0),
    "last_second": (datetime(2025, 12, 31, 23, 59, 59), 0),
    "empty_int": (datetime(2022, 1, 5, 20, 30), None),
    "word_int": (datetime(2022, 1, 5, 20, 30), None),
    "huge_int": (datetime(2022, 1, 5, 20, 30), None),
    "fraction": (datetime(2022, 1, 5, 20, 30), 1),
    "spaces": (datetime(2022, 1, 5, 20, 30), 3),
    "quoting": (datetime(2022, 1, 5, 20, 30), 1),
}


def write_raw(path, rows=RAW_ROWS, header=COLUMNS, extra=True):
    """A CSV file as the city publishes it: more columns than are kept."""
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerow([*header, "STREET_NAME"] if extra else header)
        for row in rows:
            writer.writerow([*row, "MAIN ST"] if extra else row)
    return str(path)


def clean_frame(spark, rows):
    """Cleaned records from ``(time, total, fatal, weather)``."""
    data = [
        (f"r{i}", t, total, fatal, "NONE", weather, "DAYLIGHT", "DRY", "SPEED", "NONE")
        + ((t.year, t.month) if t else (None, None))
        for i, (t, total, fatal, weather) in enumerate(rows)
    ]
    return spark.createDataFrame(data, CRASH_RECORDS.schema())

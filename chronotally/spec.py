"""What a record looks like, and the preset for the traffic-crash data."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RecordSpec:
    """Columns kept from the raw text, how each one is typed, and the years in scope."""

    columns: tuple[str, ...]
    event_time: str
    time_format: str
    integers: tuple[str, ...]
    first_year: int
    last_year: int

    def schema(self, partitioned: bool = True) -> T.StructType:
        """Explicit schema of the cleaned table (partition columns last)."""
        kinds = {name: T.IntegerType() for name in self.integers}
        kinds[self.event_time] = T.TimestampType()
        fields = [T.StructField(c, kinds.get(c, T.StringType())) for c in self.columns]
        if partitioned:
            fields += [T.StructField(c, T.IntegerType()) for c in ("year", "month")]
        return T.StructType(fields)


@dataclass(frozen=True)
class RollupSpec:
    """Names of the roll-up outputs and of the measures in them.

    ``window_sums`` and ``month_sums`` map an output column to the column it sums;
    ``categories`` maps an output table to the column it is broken down by.
    """

    event_time: str
    window_sums: Mapping[str, str]
    month_sums: Mapping[str, str]
    categories: Mapping[str, str]
    window_size: str = "1 hour"
    window_count: str = "crashes"
    group_count: str = "crash_count"
    by_window: str = "crashes_by_hour_window"
    by_date: str = "crashes_by_date"
    by_month: str = "crashes_by_month"
    sums_by_month: str = "injuries_by_month"

    def outputs(self) -> list[str]:
        return [self.by_window, self.by_date, self.by_month, self.sums_by_month, *self.categories]


# Column names, text format, year range and output names of the crash data.
CRASH_RECORDS = RecordSpec(
    columns=(
        "CRASH_RECORD_ID",
        "CRASH_DATE",
        "INJURIES_TOTAL",
        "INJURIES_FATAL",
        "MOST_SEVERE_INJURY",
        "WEATHER_CONDITION",
        "LIGHTING_CONDITION",
        "ROADWAY_SURFACE_COND",
        "PRIM_CONTRIBUTORY_CAUSE",
        "SEC_CONTRIBUTORY_CAUSE",
    ),
    event_time="CRASH_DATE",
    time_format="MM/dd/yyyy hh:mm:ss a",
    integers=("INJURIES_TOTAL", "INJURIES_FATAL"),
    first_year=2022,
    last_year=2025,
)

CRASH_ROLLUPS = RollupSpec(
    event_time="CRASH_DATE",
    window_sums={"injuries_total": "INJURIES_TOTAL", "injuries_fatal": "INJURIES_FATAL"},
    month_sums={"total_injuries": "INJURIES_TOTAL", "fatal_injuries": "INJURIES_FATAL"},
    categories={
        "crashes_by_weather": "WEATHER_CONDITION",
        "crashes_by_lighting": "LIGHTING_CONDITION",
        "crashes_by_roadway": "ROADWAY_SURFACE_COND",
    },
)

from chronotally.functions.casts import lenient_int, parse_time
from chronotally.functions.calendar import (
    calendar_columns,
    iso_week,
    period_label,
    week_start,
    weekday_name,
    year_month,
)

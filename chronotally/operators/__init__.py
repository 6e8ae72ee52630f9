from chronotally.operators.checks import (
    failing_windows,
    columns_required,
    misaligned,
    overall,
    readback_check,
    rows_read_check,
    window_duration_checks,
    window_alignment_checks,
    window_checks,
    window_sanity_checks,
    years_in_scope_check,
)
from chronotally.operators.compare import (
    reconcile_windows,
    schema_parity,
    side_by_side,
)
from chronotally.operators.filters import (
    event_time_slice,
    window_slice,
    years_between,
)
from chronotally.operators.inventory import all_present, output_inventory, run_inventory
from chronotally.operators.reuse import kept
from chronotally.operators.rollups import (
    breakdown,
    count_by_date,
    count_by_month,
    count_by_month_and,
    count_by_week,
    distinct_years,
    first_rows,
    monthly_series,
    rows_by_year,
    run_summary,
    sums_by_month,
    tumbling_windows,
    with_calendar,
    with_run,
)

from chronotally.plans.clean import CleanCounts, clean, reclean_months, typed_records, write_clean
from chronotally.plans.gold import GoldRun, outputs_by_category, outputs_by_time, time_rollup, write_analysis, write_gold

from casetrends.plans.ingest import ingest_daily_reports
from casetrends.plans.jobs import run_daily_reports, run_global, run_us
from casetrends.plans.refresh import carried_rows, refresh_series
from casetrends.plans.us import state_rollup, us_current, us_series, us_series_from_long
from casetrends.plans.world import (
    global_series_basic,
    global_series_daily,
    global_series_wide,
)

__all__ = [
    "carried_rows",
    "global_series_basic",
    "global_series_daily",
    "global_series_wide",
    "ingest_daily_reports",
    "refresh_series",
    "run_daily_reports",
    "run_global",
    "run_us",
    "state_rollup",
    "us_current",
    "us_series",
    "us_series_from_long",
]

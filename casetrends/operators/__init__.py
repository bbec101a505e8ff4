from casetrends.operators.align import (
    align_wide,
    asof_enrich,
    enrich,
    full_align,
    null_tolerant_eq,
    salted_full_join,
    stack_align,
    union_drifted,
    union_sources,
)
from casetrends.operators.inspect import column_slice, preview, profile
from casetrends.operators.project import (
    UnknownColumnsError,
    insert_column_at,
    latest_snapshot,
    null_columns,
    reject_unknown_columns,
    standardize_report,
)
from casetrends.operators.reshape import dated_structs, unnest, unpivot_wide
from casetrends.operators.rollup import rollup_region, with_global_max
from casetrends.operators.series import (
    collapse_days,
    daily_delta,
    first_row_fallback,
    latest_rows,
    on_calendar,
    ranged_series_metrics,
    series_metrics,
    series_window,
    trailing_avg,
)

__all__ = [
    "UnknownColumnsError",
    "align_wide",
    "asof_enrich",
    "collapse_days",
    "column_slice",
    "daily_delta",
    "dated_structs",
    "enrich",
    "first_row_fallback",
    "latest_rows",
    "full_align",
    "insert_column_at",
    "latest_snapshot",
    "null_columns",
    "null_tolerant_eq",
    "on_calendar",
    "preview",
    "profile",
    "ranged_series_metrics",
    "reject_unknown_columns",
    "rollup_region",
    "salted_full_join",
    "series_metrics",
    "series_window",
    "stack_align",
    "standardize_report",
    "trailing_avg",
    "union_drifted",
    "union_sources",
    "unnest",
    "unpivot_wide",
    "with_global_max",
]

from casetrends.functions.casts import blank_to_null, parse_timestamp, typed, whole_to_long
from casetrends.functions.dates import (
    compact_date,
    date_header,
    date_span,
    parse_dated_name,
    report_file_name,
    yesterday,
)
from casetrends.functions.names import has_suffix, strip_suffix
from casetrends.functions.rates import (
    implied_population,
    per_person,
    plausible_rate,
    round_to_long,
    safe_ratio,
)
from casetrends.functions.stamps import local_stamp, strip_utc_offset

__all__ = [
    "blank_to_null",
    "compact_date",
    "date_header",
    "date_span",
    "has_suffix",
    "implied_population",
    "local_stamp",
    "parse_dated_name",
    "parse_timestamp",
    "per_person",
    "plausible_rate",
    "report_file_name",
    "round_to_long",
    "safe_ratio",
    "strip_suffix",
    "strip_utc_offset",
    "typed",
    "whole_to_long",
    "yesterday",
]

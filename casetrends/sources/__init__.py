from casetrends.sources.daily import discover_columns, read_daily, report_headers
from casetrends.sources.extract import export_csv, export_table
from casetrends.sources.files import scratch_path
from casetrends.sources.headers import file_headers, header_groups
from casetrends.sources.tables import (
    copy_table,
    latest_partition,
    load,
    materialize,
    partition_date,
    replace_partitions,
    write_partitioned,
)
from casetrends.sources.wide import read_wide, wide_rejects, write_wide

__all__ = [
    "copy_table",
    "discover_columns",
    "export_csv",
    "export_table",
    "file_headers",
    "header_groups",
    "latest_partition",
    "load",
    "materialize",
    "partition_date",
    "read_daily",
    "read_wide",
    "replace_partitions",
    "report_headers",
    "scratch_path",
    "wide_rejects",
    "write_partitioned",
    "write_wide",
]

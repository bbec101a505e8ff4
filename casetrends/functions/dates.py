"""Dates in headers, file names and columns."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats used by the files and tables.
HEADER_FORMAT = "%m/%d/%y"
COLUMN_FORMAT = "dt_%Y%m%d"
DAILY_FILE_FORMAT = "%m-%d-%Y"
DATED_COLUMN = re.compile(r"dt_\d{8}")

Day = str | dt.date


def as_day(value: Day) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    if isinstance(value, str):
        return dt.datetime.strptime(value, "%Y-%m-%d").date()
    raise TypeError(f"a date or a 'YYYY-mm-dd' text is needed, not {value!r}")


def date_header(header: str) -> str:
    """``1/22/20`` -> ``dt_20200122``."""
    return dt.datetime.strptime(header, HEADER_FORMAT).strftime(COLUMN_FORMAT)


def column_day(column: str) -> dt.date:
    """``dt_20200122`` -> 2020-01-22, for column names."""
    return dt.datetime.strptime(column, COLUMN_FORMAT).date()


def day_column(day: Day) -> str:
    return as_day(day).strftime(COLUMN_FORMAT)


def date_columns(names: list[str]) -> list[str]:
    return sorted(name for name in names if DATED_COLUMN.fullmatch(name))


def parse_dated_name(name: Column) -> Column:
    """``dt_20200122`` -> DATE, for values."""
    return F.to_date(F.substring(name, 4, 8), "yyyyMMdd")


def report_file_name(day: Column) -> Column:
    """DATE -> ``01-22-2020``, the stem of a daily report file."""
    return F.date_format(day, "MM-dd-yyyy")


def compact_date(day: Column) -> Column:
    """DATE -> ``20200122``."""
    return F.date_format(day, "yyyyMMdd")


def date_span(start: Column, end: Column) -> Column:
    """All days from ``start`` to ``end``, both included; empty when the end comes first."""
    days = F.sequence(start, end, F.expr("interval 1 day"))
    return F.when(start <= end, days).otherwise(F.array().cast("array<date>"))


def yesterday(asof: Column | None = None) -> Column:
    """The day before ``asof``, by default the day before the run."""
    return F.date_sub(F.current_date() if asof is None else asof, 1)


def expand_days(day: Day | list[Day], end_day: Day | None = None) -> list[dt.date]:
    """One day, a list of days, or every day of an inclusive range."""
    if isinstance(day, list):
        if end_day is not None:
            raise TypeError("a list of days takes no end day")
        return [as_day(d) for d in day]
    first = as_day(day)
    last = first if end_day is None else as_day(end_day)
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]

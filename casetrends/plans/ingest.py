"""Daily report files into a table with one partition per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from casetrends.functions.dates import Day, expand_days
from casetrends.schemas import ReportLayout
from casetrends.sources.daily import read_daily
from casetrends.sources.tables import replace_partitions


def ingest_daily_reports(
    spark: SparkSession,
    base: str,
    table: str,
    layout: ReportLayout,
    day: Day | list[Day] | None = None,
    end_day: Day | None = None,
    mode: str = "strict",
    day_column: str = "report_dt",
) -> None:
    """Load one day, a list of days, or the days ``day`` to ``end_day`` into their partitions.

    The default is the day before the run. All days are one read and one write. Loading a day
    again replaces it.
    """
    if day is None:
        day = dt.date.today() - dt.timedelta(days=1)
    days = expand_days(day, end_day)
    reports = read_daily(spark, base, layout, days, mode, day_column)
    replace_partitions(reports, table, day_column, days)

"""Scheduled runs: from files to tables to the published snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from casetrends.functions.dates import Day
from casetrends.functions.stamps import Instant
from casetrends.operators.project import latest_snapshot
from casetrends.plans.ingest import ingest_daily_reports
from casetrends.plans.us import us_series
from casetrends.plans.world import global_series_daily
from casetrends.schemas import GLOBAL_DAILY, US_CONFIRMED_IDS, US_DAILY, US_DEATHS_IDS
from casetrends.sources.extract import export_csv
from casetrends.sources.tables import latest_partition, materialize, write_partitioned
from casetrends.sources.wide import read_wide


def run_daily_reports(
    spark: SparkSession,
    us_files: str,
    global_files: str,
    database: str,
    day: Day | list[Day] | None = None,
    end_day: Day | None = None,
) -> None:
    """Ingest US and global daily reports into ``daily_us`` and ``daily_global``."""
    for files, layout in ((us_files, US_DAILY), (global_files, GLOBAL_DAILY)):
        ingest_daily_reports(spark, files, f"{database}.{layout.name}", layout, day, end_day)


def run_us(
    spark: SparkSession,
    confirmed_files: str,
    deaths_files: str,
    database: str,
    extract_path: str,
    now: Instant = None,
) -> DataFrame:
    """Load the wide files, build ``us_series`` and ``us_current`` and export the latter.

    The raw tables are written first, so that the series reads typed columns and the population
    join reads two of them. Give every run an ``extract_path`` of its own; the publishing stream
    knows an upload by its path.
    """
    confirmed = materialize(
        read_wide(spark, confirmed_files, US_CONFIRMED_IDS), f"{database}.us_confirmed_raw"
    )
    deaths = materialize(read_wide(spark, deaths_files, US_DEATHS_IDS), f"{database}.us_deaths_raw")
    series = write_partitioned(us_series(confirmed, deaths, now), f"{database}.us_series")
    newest = latest_snapshot(series, last=latest_partition(spark, f"{database}.us_series"))
    current = materialize(newest, f"{database}.us_current")
    export_csv(current, extract_path, files=1)  # one day is one file by contract
    return current


def run_global(
    spark: SparkSession,
    database: str,
    extract_path: str,
    now: Instant = None,
    collapse: bool = False,
) -> DataFrame:
    """Build ``global_series`` from the daily report tables and export it.

    ``collapse`` keeps one row of those that repeat a place and day.
    """
    us, world = (spark.table(f"{database}.{layout.name}") for layout in (US_DAILY, GLOBAL_DAILY))
    series = write_partitioned(
        global_series_daily(us, world, now=now, collapse=collapse), f"{database}.global_series"
    )
    export_csv(series, extract_path)
    return series

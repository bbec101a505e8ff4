"""Daily report CSVs, one per date, whose headers drift over the years."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrends.functions.dates import DAILY_FILE_FORMAT, Day, as_day
from casetrends.operators.align import union_drifted
from casetrends.operators.project import reject_unknown_columns, standardize_report
from casetrends.schemas import ReportLayout
from casetrends.sources.files import exact, read_text_csv
from casetrends.sources.headers import HeaderGroup, file_headers, header_groups

# A report is a file, or a folder of part files, named MM-DD-YYYY.csv.
REPORT_NAME = r".*(\d{2}-\d{2}-\d{4})\.csv(?:/|$)"


def report_day() -> Column:
    """The date in the name of a report file; NULL for other files."""
    return F.try_to_date(F.regexp_extract("file_path", REPORT_NAME, 1), "MM-dd-yyyy")


def report_headers(
    spark: SparkSession, base: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """``file_path, header, multi, day`` of the reports below ``base`` between two days."""
    keep = report_day().isNotNull()
    if first is not None:
        keep &= report_day() >= F.lit(first)
    if last is not None:
        keep &= report_day() <= F.lit(last)
    return file_headers(spark, [base], keep=keep).withColumn("day", report_day())


def _groups_of_days(
    spark: SparkSession, base: str, days: set[dt.date]
) -> tuple[list[str], list[HeaderGroup]]:
    """What to read for some days: the names that they have right below ``base``, as the
    publisher lays them out, or where one is missing there, all that lies below."""
    names = ",".join(d.strftime(DAILY_FILE_FORMAT) for d in sorted(days))
    keep = report_day().isin([F.lit(d) for d in sorted(days)])
    missing = days
    for root in (f"{exact(base.rstrip('/'))}/*{{{names}}}.csv", exact(base)):
        try:
            groups = header_groups(file_headers(spark, [root], keep=keep), report_day())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        missing = days.difference(*[g.days for g in groups])
        if not missing:
            return [root], groups
    raise FileNotFoundError(f"no report below {base} for {sorted(map(str, missing))}")


def read_daily(
    spark: SparkSession,
    base: str,
    layout: ReportLayout,
    days: list[Day] | None = None,
    mode: str = "strict",
    day_column: str = "report_dt",
) -> DataFrame:
    """All reports of ``days`` (default: all there are) in the layout's shape plus their day.

    Headers are found first, by tasks, and checked against the layout. Files are scanned once per
    distinct header, of which there are few, and the scans are unioned into one plan. A file
    without a header fails before anything is written, so does, in the strict mode, a row with
    another number of fields than its header. Only files with quoted line breaks are one
    task's each. Reports of some days are looked up by their names, without a walk of the folder.
    """
    if days is None:
        paths, keep = [exact(base)], report_day().isNotNull()
        groups = header_groups(file_headers(spark, paths, keep=keep), report_day())
        if not groups:
            raise FileNotFoundError(f"no daily report below {base}")
    else:
        wanted = {as_day(d) for d in days}
        keep = report_day().isin([F.lit(d) for d in sorted(wanted)])
        paths, groups = _groups_of_days(spark, base, wanted)
    reject_unknown_columns({g.example: g.header for g in groups}, layout)
    frames = []
    for group in groups:
        reader_mode = "FAILFAST" if mode == "strict" else "PERMISSIVE"
        raw = read_text_csv(spark, paths, group, mode=reader_mode, keep=keep, whole_rows=True)
        raw = raw.withColumn(day_column, report_day()).drop("file_path")
        frames.append(standardize_report(raw, layout, mode, keep=(day_column,)))
    return union_drifted(*frames)


def discover_columns(
    spark: SparkSession, base: str, start: Day | None = None, end: Day | None = None
) -> DataFrame:
    """Every header spelling between two days, with the first and last day it occurs.

    ``end`` defaults to the day before the run. Nothing of it passes through the driver.
    """
    last = dt.date.today() - dt.timedelta(days=1) if end is None else as_day(end)
    heads = report_headers(spark, exact(base), None if start is None else as_day(start), last)
    named = F.when(
        F.col("header").isNull(),
        F.raise_error(F.concat(F.lit("file without a header: "), "file_path")).cast("array<string>"),
    ).otherwise(F.col("header"))
    return (
        heads.select("day", F.explode(named).alias("column"))
        .groupBy("column")
        .agg(F.min("day").alias("first_dt"), F.max("day").alias("last_dt"))
    )

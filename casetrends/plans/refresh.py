"""A stored series brought up to date from its earliest corrected day on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casetrends.functions.dates import Day, as_day
from casetrends.operators.project import quoted
from casetrends.operators.series import AVG_ROWS, series_metrics
from casetrends.sources.tables import replace_partitions


def carried_rows(
    series: DataFrame, keys: Sequence[str], since: Day, order: str = "dt", rows: int = max(AVG_ROWS)
) -> DataFrame:
    """The last ``rows`` rows of each series before a day: what its later rows look back on.

    The longest average looks at one new count less than that before a row, and the first of these
    at one total more.
    """
    latest = Window.partitionBy(*[F.col(quoted(c)) for c in keys]).orderBy(F.desc(order))
    before = series.filter(F.col(order) < F.lit(as_day(since)))
    return before.withColumn("back__", F.row_number().over(latest)).filter(
        F.col("back__") <= rows
    ).drop("back__")


def refresh_series(
    spark: SparkSession,
    table: str,
    fresh: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    since: Day,
    order: str = "dt",
    rows: Sequence[int] = AVG_ROWS,
) -> None:
    """Recompute the days from ``since`` on of a table that ``series_metrics`` made, partitioned by
    ``order``.

    ``fresh`` has all rows of these days as they should be, with the table's columns but for
    new counts and averages. Earlier days are read for the last rows of each series, in the few
    columns needed, and keep their files; the table is as after a full rebuild. A later day that
    ``fresh`` lacks ends up empty. A row of an earlier day is an error, and a series must not
    repeat a day. Running it twice leaves the same table.
    """
    stored = spark.table(table)
    given = [c for c in stored.columns if c in fresh.columns]
    missing = [f"total_{m}" for m in metrics if f"total_{m}" not in given]
    if missing or not {order, *keys} <= set(given):
        raise ValueError(f"{table} and the fresh rows must both have {[order, *keys, *missing]}")
    names = [F.col(quoted(c)) for c in given]
    carried = carried_rows(stored.select(*names), keys, since, order, max(rows, default=1))
    both = fresh.select(*names).withColumn("own__", F.lit(True)).unionByName(
        carried.withColumn("own__", F.lit(False))
    )
    done = series_metrics(both, keys, metrics, order, rows).filter("own__").drop("own__")
    replace_partitions(done, table, order, since=since)

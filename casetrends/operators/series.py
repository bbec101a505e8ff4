"""Day-over-day changes and trailing averages along a location's series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from casetrends.operators.project import quoted

AVG_DIGITS = 1
AVG_ROWS = (7, 28)


def series_window(keys: Sequence[str], order: str = "dt") -> WindowSpec:
    """A series in date order; NULL in a key is a group of its own."""
    return Window.partitionBy(*keys).orderBy(order)


def delta(total: Column, window: WindowSpec) -> Column:
    """Change since the previous row of the series (not the previous day); may be negative."""
    return total - F.lag(total).over(window)


def first_row_fallback(change: Column, total: Column) -> Column:
    """A row without a previous total reports its total as new."""
    return F.coalesce(change, total)


def rolling_mean(value: Column, window: WindowSpec, rows: int, digits: int = AVG_DIGITS) -> Column:
    return F.round(F.avg(value).over(window.rowsBetween(1 - rows, 0)), digits)


def daily_delta(
    df: DataFrame,
    keys: Sequence[str],
    metric: str,
    order: str = "dt",
    fallback: bool = False,
) -> DataFrame:
    """Add ``daily_new_<metric>`` from ``total_<metric>``."""
    total = F.col(f"total_{metric}")
    change = delta(total, series_window(keys, order))
    return df.withColumn(
        f"daily_new_{metric}", first_row_fallback(change, total) if fallback else change
    )


def trailing_avg(
    df: DataFrame,
    keys: Sequence[str],
    metric: str,
    rows: int = 7,
    digits: int = AVG_DIGITS,
    order: str = "dt",
) -> DataFrame:
    """Add ``daily_new_<metric>_<rows>d_ma``: mean of the last ``rows`` rows, nulls skipped."""
    value = F.col(f"daily_new_{metric}")
    mean = rolling_mean(value, series_window(keys, order), rows, digits)
    return df.withColumn(f"daily_new_{metric}_{rows}d_ma", mean)


def collapse_days(df: DataFrame, keys: Sequence[str], order: str = "dt") -> DataFrame:
    """One row per key and day: the greatest value of every other column.

    For rows that have a part of a day's metrics each, such as a full join leaves them: the
    result may take columns from different rows. ``latest_rows`` keeps rows whole. Rows are
    combined before the shuffle, so a key with very many rows arrives at the windows as one row per
    day, and their order is no longer arbitrary.
    """
    rest = [c for c in df.columns if c not in (*keys, order)]
    grouped = df.groupBy(*keys, order).agg(*[F.max(F.col(quoted(c))).alias(c) for c in rest])
    return grouped.select(*[F.col(quoted(c)) for c in df.columns])


def latest_rows(
    df: DataFrame, keys: Sequence[str], by: Sequence[str] = (), order: str = "dt"
) -> DataFrame:
    """One whole row per key and day, of those that repeat it: the greatest one by the columns
    ``by`` in turn, then by all others in turn. NULL is less than any value.

    Rows are combined before the shuffle, as in ``collapse_days``. The result does not depend on the
    order of the input: rows that tie in all columns are equal.
    """
    chosen = [*by, *[c for c in df.columns if c not in (*keys, order, *by)]]
    if not chosen:
        return df.distinct()
    best = F.max(F.struct(*[F.col(quoted(c)) for c in chosen])).alias("best__")
    grouped = df.groupBy(*[F.col(quoted(c)) for c in (*keys, order)]).agg(best)
    return grouped.select(
        *[
            F.col("best__").getField(c).alias(c) if c in chosen else F.col(quoted(c))
            for c in df.columns
        ]
    )


FILLS = (None, "ffill")


def on_calendar(
    df: DataFrame,
    keys: Sequence[str],
    order: str = "dt",
    fill: str | None = "ffill",
    until: Column | None = None,
) -> DataFrame:
    """A row for every day of a series from its first to its last, or to ``until`` if that is later.

    A day that the series lacks takes all values of the last row before it (``fill="ffill"``), or
    is NULL but for its key and day (None). Rows that are there stay as they are; a series that
    repeats a day keeps the repeats, and a gap then takes the values of one of them. A row without
    a day stays and fills nothing.
    """
    if fill not in FILLS:
        raise ValueError(f"fill must be one of {FILLS}, not {fill!r}")
    here, given = F.col(quoted(order)), F.col("given__")
    following = F.date_sub(F.lead(here).over(series_window(keys, order)), 1)
    stop = F.greatest(F.coalesce(following, here if until is None else until), here)
    spread = df.withColumns({"given__": here, "stop__": stop}).withColumn(
        "day__", F.explode_outer(F.when(here.isNotNull(), F.sequence(here, F.col("stop__"))))
    )
    columns = []
    for name in df.columns:
        value = F.col(quoted(name))
        if name == order:
            value = F.col("day__")
        elif fill is None and name not in keys:
            value = F.when(given.eqNullSafe(F.col("day__")), value)
        columns.append(value.alias(name))
    return spread.select(*columns)


def series_metrics(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    order: str = "dt",
    rows: Sequence[int] = AVG_ROWS,
    filled: bool = False,
    unique: bool = False,
    calendar: bool = False,
    fill: str | None = "ffill",
) -> DataFrame:
    """Daily new counts and trailing averages of every metric.

    Averages count rows. With ``calendar`` the series first get a row for every day
    (``on_calendar`` with ``fill``), so that they count days.

    All windows share one specification, so the plan has one exchange and one sort. A group
    is one series: with one row per key and day it is bounded by the number of days, however
    many rows the table has. ``collapse_days`` makes that so for a table that repeats days.

    ``filled`` says that no total is NULL. The new counts of a frame then add up to the
    difference of two totals, and an average costs one look back instead of a pass over its
    frame. ``unique`` fails the job when a key has a day twice.
    """
    if calendar:
        df = on_calendar(df, keys, order, fill)
    window = series_window(keys, order)
    totals = {m: F.col(f"total_{m}") for m in metrics}
    new = {f"daily_new_{m}": first_row_fallback(delta(t, window), t) for m, t in totals.items()}
    means = [(m, n, f"daily_new_{m}_{n}d_ma") for n in rows for m in metrics]
    if filled:
        seen = F.row_number().over(window)
        new |= {
            name: F.round(
                first_row_fallback(totals[m] - F.lag(totals[m], n).over(window), totals[m])
                / F.least(seen, F.lit(n)),
                AVG_DIGITS,
            )
            for m, n, name in means
        }
    if unique:
        new["repeated__"] = F.col(order) == F.lag(order).over(window)
    changed = df.withColumns(new)
    if unique:
        complaint = F.raise_error(F.lit(f"{list(keys)}: a day occurs twice")).cast("boolean")
        changed = changed.filter(F.when(F.col("repeated__"), complaint).otherwise(True))
        changed = changed.drop("repeated__")
    if filled:
        return changed
    return changed.withColumns(
        {name: rolling_mean(F.col(f"daily_new_{m}"), window, n) for m, n, name in means}
    )


def ranged_series_metrics(
    df: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[str],
    path: str,
    order: Sequence[str] = ("dt",),
    rows: Sequence[int] = AVG_ROWS,
) -> DataFrame:
    """``series_metrics`` for series that are too long for one task, or repeat a day.

    The rows are sorted by key, then ``order``, then all their other columns as they stand in the
    frame (NULLs first), so their order is total but for equal rows, which are the same in any
    order. Ranges of that order are windowed apart. Each range of a series also gets as many rows
    before it as its averages look back on, and one more for the first change; they come from the
    tails of the ranges before it.

    The sorted rows are written to ``path``, a folder that executors share, so that all steps
    see the same ranges. A task holds a range; the tails of a series are one row per range.
    """
    reach = max(rows, default=1)
    rest = [c for c in df.columns if c not in (*keys, *order)]
    sorting = [F.col(quoted(c)) for c in (*keys, *order, *rest)]
    placed = (
        df.repartitionByRange(*sorting)
        .sortWithinPartitions(*sorting)
        .withColumns({"range__": F.spark_partition_id(), "at__": F.monotonically_increasing_id()})
    )
    placed.write.parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    series = [F.col(quoted(c)) for c in keys]
    own = Window.partitionBy(*series, "range__").orderBy(F.desc("at__"))
    packed = F.struct(*[F.col(quoted(c)) for c in stored.columns])
    # Only the last rows of each range of a series are grouped.
    tails = (
        stored.withColumn("back__", F.row_number().over(own))
        .filter(F.col("back__") <= reach)
        .groupBy(*series, "range__")
        .agg(F.sort_array(F.collect_list(F.struct("at__", packed.alias("row")))).alias("tail__"))
    )
    earlier = Window.partitionBy(*series).orderBy("range__").rowsBetween(-reach, -1)
    before = F.flatten(F.collect_list("tail__").over(earlier))
    carried = (
        tails.select("range__", before.alias("rows__"))
        .filter(F.size("rows__") > 0)
        .select(
            F.col("range__").alias("to__"),
            F.explode(F.slice("rows__", -F.least(F.size("rows__"), F.lit(reach)), F.lit(reach))).alias("x__"),
        )
        .select("x__.row.*", "to__")
        .withColumn("range__", F.col("to__"))
        .drop("to__")
    )
    both = stored.withColumn("own__", F.lit(True)).unionByName(carried.withColumn("own__", F.lit(False)))
    done = series_metrics(both, [*keys, "range__"], metrics, "at__", rows)
    return done.filter("own__").drop("own__", "range__", "at__")

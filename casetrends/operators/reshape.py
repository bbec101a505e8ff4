"""Wide (one column per date) to long (one row per date)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.functions.dates import column_day, date_columns
from casetrends.operators.project import quoted


def day_literals(days: list[dt.date]) -> Column:
    return F.expr(f"array({', '.join(f'DATE {chr(39)}{day}{chr(39)}' for day in days)})")


def dated_structs(df: DataFrame, date_cols: list[str], metric: str, name: str = "arr") -> DataFrame:
    """Add ``name``: one ``struct(dt, total_<metric>)`` per date column, in the given order.

    The dates are one constant array zipped with the values, which stays cheap to compile
    with a thousand and more date columns; a struct expression per column does not.
    """
    days = day_literals([column_day(c) for c in date_cols])
    values = F.array(*date_cols)
    return df.withColumn(name, F.arrays_zip(days.alias("dt"), values.alias(f"total_{metric}")))


def unnest(df: DataFrame, array: str, filled: bool = False) -> DataFrame:
    """One row per array element with the struct fields as columns; empty arrays vanish.

    ``filled`` says that no array is empty or NULL. Spark then infers no filter on the arrays; one on
    an array of very many columns, each computed, makes later plans slow to optimize.
    """
    rest = [F.col(quoted(c)) for c in df.columns if c != array]
    inline = F.inline_outer if filled else F.inline
    return df.select(*rest, inline(F.col(quoted(array))))


def unpivot_wide(df: DataFrame, ids: list[str], metric: str) -> DataFrame:
    """``(dt, *ids, total_<metric>)``, one row per location and date, missing values kept."""
    dates = date_columns(df.columns)
    dated = dated_structs(df, dates, metric)
    slim = dated.select(*[F.col(quoted(c)) for c in ids], "arr")
    return unnest(slim, "arr", filled=bool(dates)).select("dt", *[F.col(quoted(c)) for c in ids], f"total_{metric}")

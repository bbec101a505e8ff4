"""Roll-ups and whole-table maxima."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rollup_region(df: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sum county rows up to ``by``; sums run on the map side before the shuffle."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums])


def with_global_max(
    df: DataFrame, column: str = "dt", alias: str = "last_updated_dt", over: DataFrame | None = None
) -> DataFrame:
    """The maximum over all rows as a column.

    A scalar subquery: one aggregate whose single value is a constant in the main plan. A
    window over the whole table would bring every row to one task. ``over`` may name a
    cheaper frame with the same maximum, such as the input before joins and windows.
    """
    newest = (df if over is None else over).agg(F.max(column)).scalar()
    return df.withColumn(alias, newest)

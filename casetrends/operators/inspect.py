"""Looking at frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.operators.project import quoted

PREVIEW_ROWS = 20


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: list[str | Column] | None = None) -> DataFrame:
    """The first ``n`` rows; any rows unless an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def column_slice(df: DataFrame, start: int = 0, stop: int = 15) -> DataFrame:
    return df.select(*[F.col(quoted(c)) for c in df.columns[start:stop]])


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, row count and count of present values."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(*[F.count(F.col(quoted(c))) for c in df.columns]).alias("present"),
    )
    labels = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(dtype).alias("dtype")
            )
            for i, (name, dtype) in enumerate(df.dtypes)
        ]
    )
    each = counted.select("rows", F.inline(F.arrays_zip(labels.alias("of"), F.col("present"))))
    return each.select("of.position", "of.column", "of.dtype", "rows", "present")

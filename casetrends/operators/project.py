"""Projections: canonical columns out of drifting ones, typed null padding, snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.functions.casts import typed
from casetrends.schemas import ReportLayout


class UnknownColumnsError(ValueError):
    """A report carries a header that its layout does not know."""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def reject_unknown_columns(
    headers: Mapping[str, Iterable[str]], layout: ReportLayout
) -> None:
    """Check ``{file: header}`` before anything is planned; the error lists file and columns."""
    problems = []
    for path, columns in headers.items():
        columns = list(columns)
        unknown = [c for c in columns if c not in layout.aliases]
        repeated = sorted({c for c in columns if columns.count(c) > 1})
        if unknown:
            problems.append(f"{path}: unknown {unknown}")
        if repeated:
            problems.append(f"{path}: repeated {repeated}")
    if problems:
        raise UnknownColumnsError(f"{layout.name}: " + "; ".join(problems))


def standardize_report(
    df: DataFrame, layout: ReportLayout, mode: str = "strict", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Text columns under any known spelling to the canonical columns, types and order.

    Two spellings of one column in the same frame are coalesced in layout order. Columns of
    the layout that the frame lacks become typed nulls. ``keep`` columns go in front as is.
    """
    present = set(df.columns) - set(keep)
    reject_unknown_columns({"frame": [c for c in df.columns if c in present]}, layout)
    columns = [F.col(quoted(name)) for name in keep]
    for field in layout.schema.fields:
        found = [
            typed(quoted(s), field.dataType, mode, label=s)
            for s in layout.spellings(field.name)
            if s in present
        ]
        value = F.coalesce(*found) if found else F.lit(None).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def null_columns(df: DataFrame, columns: Mapping[str, T.DataType | str]) -> DataFrame:
    """Pad a union branch with typed nulls."""
    return df.withColumns({name: F.lit(None).cast(dtype) for name, dtype in columns.items()})


def insert_column_at(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    order = list(df.columns)
    order.insert(position, name)
    return df.withColumn(name, value).select(*[F.col(quoted(c)) for c in order])


def latest_snapshot(
    df: DataFrame, order: str = "dt", last: dt.date | None = None, over: DataFrame | None = None
) -> DataFrame:
    """Rows of the newest day of the whole frame.

    A known ``last`` becomes a literal filter, which prunes partitions when planning. Without
    it the day is a scalar subquery over ``over`` (by default the frame itself), which prunes
    partitions when the scan starts. Give ``over`` the cheapest frame with the same days.
    """
    if last is not None:
        return df.filter(F.col(order) == F.lit(last))
    newest = (df if over is None else over).agg(F.max(order)).scalar()
    return df.filter(F.col(order) == newest)

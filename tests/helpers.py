"""Small frames for tests and readings of plans."""

import datetime as dt
import re


def day(n: int) -> dt.date:
    return dt.date(2020, 1, 21) + dt.timedelta(days=n)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))

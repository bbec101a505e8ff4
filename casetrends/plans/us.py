"""County series, its latest-day snapshot and the roll-up to states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetrends.functions.dates import column_day, date_columns
from casetrends.functions.rates import safe_ratio
from casetrends.functions.stamps import Instant, local_stamp
from casetrends.operators.align import align_wide, enrich, full_align, stack_align
from casetrends.operators.project import quoted
from casetrends.operators.rollup import rollup_region
from casetrends.operators.series import AVG_DIGITS, AVG_ROWS, series_metrics
from casetrends.schemas import US_PLACE, US_SERIES_COLUMNS, US_SERIES_KEY

METRICS = ("confirmed", "deaths")


def _finish(series: DataFrame, last_day: Column, now: Instant) -> DataFrame:
    confirmed, deaths = F.col("total_confirmed"), F.col("total_deaths")
    return series.withColumns(
        {
            "incident_rate": safe_ratio(confirmed, F.col("population")),
            "case_fatality_rate": safe_ratio(deaths, confirmed),
            "last_updated_dt": last_day,
            "last_updated_ts": local_stamp(now),
        }
    ).select(*US_SERIES_COLUMNS)


def us_series(
    confirmed: DataFrame,
    deaths: DataFrame,
    now: Instant = None,
    one_row_per_place: bool = False,
) -> DataFrame:
    """County series from the wide confirmed and deaths frames (deaths carry the population).

    The frames meet as one row per county; long rows appear only after the last exchange.

    ``one_row_per_place`` says that neither frame repeats a county. The population then comes
    with the deaths row instead of by a join with the deaths table, and a repeated county fails
    the job. Without it repeats multiply rows, as joins do.
    """
    axes = [date_columns(df.columns) for df in (confirmed, deaths)]
    same_days = axes[0] == axes[1]
    direct = one_row_per_place and same_days
    aligned = align_wide(
        {"confirmed": confirmed, "deaths": deaths},
        on=US_SERIES_KEY,
        describe=US_PLACE,
        carry={"deaths": ["population"]} if direct else None,
        attributes=None if direct else deaths.select(*US_SERIES_KEY, "population"),
    )
    if same_days:
        last_day = F.lit(column_day(axes[0][-1]))
    else:
        last_day = _last_day_of_rows(confirmed, deaths)
    series = series_metrics(
        aligned, US_SERIES_KEY, METRICS, filled=True, unique=one_row_per_place
    )
    return _finish(series, last_day, now)


def _last_day_of_rows(*wides: DataFrame) -> Column:
    """The newest date column among the frames that have rows."""
    found = []
    for df in wides:
        last = F.lit(column_day(date_columns(df.columns)[-1]))
        any_row = df.select(F.lit(1).alias("one")).limit(1)
        found.append(any_row.agg(F.max(F.when(F.col("one") == 1, last))).scalar())
    return F.greatest(*found)


def us_series_from_long(
    confirmed: DataFrame,
    deaths: DataFrame,
    population: DataFrame,
    now: Instant = None,
    one_row_per_day: bool = False,
    over: DataFrame | None = None,
) -> DataFrame:
    """The same from long frames ``(dt, *place, total_<metric>)`` and a population table.

    ``one_row_per_day`` says that neither frame repeats a county and day. They are then stacked
    and grouped on the partitioning that the windows use, one exchange in place of three, and
    a repeated row fails the job. Without it the frames are joined, repeats included.

    The newest day is looked up in both frames, or in ``over``, a cheaper frame with the same
    last ``dt``, which pays when the long frames are themselves costly to compute.
    """
    keys = ["dt", *US_SERIES_KEY]
    describe = [c for c in US_PLACE if c not in US_SERIES_KEY]
    if one_row_per_day:
        aligned = stack_align(
            [confirmed, deaths], on=keys, describe=describe, cluster_by=US_SERIES_KEY
        )
    else:
        aligned = full_align([confirmed, deaths], on=keys, describe=describe)
    located = enrich(aligned, population, US_SERIES_KEY, ["population"])
    days = confirmed.select("dt").union(deaths.select("dt")) if over is None else over
    series = series_metrics(located, US_SERIES_KEY, METRICS, filled=True)
    return _finish(series, days.agg(F.max("dt")).scalar(), now)


def us_current(
    confirmed: DataFrame,
    deaths: DataFrame,
    now: Instant = None,
    one_row_per_place: bool = False,
) -> DataFrame:
    """The latest day of ``us_series``, computed from as many date columns as it needs.

    The longest average looks at 28 rows and the first of their changes at one more. When
    both frames have the same dates, a county has every one of them, and older date columns
    cannot reach the last row; they are not read.

    With ``one_row_per_place`` (see ``us_series``) the row is computed from the columns alone,
    without windows: four of them, as totals are never NULL here and new counts add up.
    """
    axes = [date_columns(df.columns) for df in (confirmed, deaths)]
    if axes[0] != axes[1]:
        series = us_series(confirmed, deaths, now)
        return series.filter(F.col("dt") == F.col("last_updated_dt"))
    if one_row_per_place:
        return _current_from_columns(confirmed, deaths, axes[0], now)
    needed = axes[0][-(max(AVG_ROWS) + 1) :]
    older = set(axes[0]) - set(needed)
    trimmed = [df.select(*[quoted(c) for c in df.columns if c not in older]) for df in (confirmed, deaths)]
    last_day = column_day(needed[-1])
    return us_series(*trimmed, now).filter(F.col("dt") == F.lit(last_day))


def _current_from_columns(
    confirmed: DataFrame, deaths: DataFrame, axis: list[str], now: Instant
) -> DataFrame:
    back = {n: axis[-1 - n] for n in (1, *AVG_ROWS) if n < len(axis)}
    looked_at = [axis[-1], *back.values()]
    sides = []
    for metric, df in zip(METRICS, (confirmed, deaths)):
        extra = ["population"] if metric == "deaths" else []
        totals = [F.col(c).alias(f"{metric}_{c}") for c in looked_at]
        sides.append(df.select(*US_PLACE, *totals, *extra))
    place = [c for c in US_PLACE if c not in US_SERIES_KEY]
    joined = full_align(sides, on=US_SERIES_KEY, describe=place, fill=None)

    copies = F.count(F.lit(1)).over(Window.partitionBy(*US_SERIES_KEY))
    complaint = F.raise_error(F.lit(f"{list(US_SERIES_KEY)}: a place occurs twice")).cast("boolean")
    checked = joined.withColumn("copies__", copies).filter(
        F.when(F.col("copies__") > 1, complaint).otherwise(True)
    )

    def total(metric: str, column: str) -> Column:
        return F.coalesce(f"{metric}_{column}", F.lit(0))

    def added(metric: str, n: int) -> Column:
        """New counts of the last ``n`` days; of all days when there are no more."""
        newest = total(metric, axis[-1])
        return newest - total(metric, back[n]) if n in back else newest

    values = {"dt": F.lit(column_day(axis[-1]))}
    for m in METRICS:
        values[f"total_{m}"] = total(m, axis[-1])
        values[f"daily_new_{m}"] = added(m, 1)
        for n in AVG_ROWS:
            values[f"daily_new_{m}_{n}d_ma"] = F.round(added(m, n) / min(n, len(axis)), AVG_DIGITS)
    return _finish(checked.withColumns(values), F.lit(column_day(axis[-1])), now)


def state_rollup(series: DataFrame) -> DataFrame:
    """County series to states: population and totals per day."""
    return rollup_region(
        series,
        by=["dt", "province_state", "country_region"],
        sums=["population", *[f"total_{m}" for m in METRICS]],
    )

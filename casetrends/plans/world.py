"""Global series, from daily reports or from the wide files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.functions.dates import column_day, date_columns
from casetrends.functions.rates import RATE_DIGITS, implied_population, per_person, safe_ratio
from casetrends.functions.stamps import Instant, local_stamp
from casetrends.operators.align import align_wide, asof_enrich, union_drifted, union_sources
from casetrends.operators.project import null_columns
from casetrends.operators.series import (
    AVG_ROWS,
    collapse_days,
    delta,
    first_row_fallback,
    latest_rows,
    series_metrics,
    series_window,
)
from casetrends.schemas import GLOBAL_PLACE, GLOBAL_SERIES_KEY
from casetrends.sources.tables import partition_date

# Labels in the reports that are filtered out.
NOT_A_STATE = "Recovered"
US_COUNTRY = "US"

DAILY_METRICS = ("confirmed", "deaths", "recovered", "active")
WIDE_METRICS = ("confirmed", "deaths", "recovered")


def report_rows(reports: DataFrame, keep: Column, day: str, tested: bool) -> DataFrame:
    """One branch of the daily union: filter, rename, and bring rates to one unit."""
    columns = [
        partition_date(day),
        *GLOBAL_PLACE,
        *[F.col(m).alias(f"total_{m}") for m in DAILY_METRICS],
        per_person(F.col("incident_rate")).alias("incident_rate"),
        F.round("case_fatality_ratio", RATE_DIGITS).alias("case_fatality_rate"),
    ]
    rows = reports.filter(keep)
    if tested:
        return rows.select(
            *columns,
            "total_test_results",
            per_person(F.col("testing_rate"), RATE_DIGITS).alias("testing_rate"),
        )
    return null_columns(
        rows.select(*columns), {"total_test_results": "bigint", "testing_rate": "double"}
    )


def _averages(metrics: Sequence[str]) -> list[str]:
    return [f"daily_new_{m}_{n}d_ma" for n in AVG_ROWS for m in metrics]


def global_series_daily(
    us: DataFrame,
    world: DataFrame,
    day: str = "report_dt",
    now: Instant = None,
    collapse: bool = False,
    last_day: Column | None = None,
) -> DataFrame:
    """Series of US states and of places outside the US, from the daily report tables.

    Rows whose compared label is NULL are dropped, as the comparison is not true for them.
    ``case_fatality_rate`` is the reports' own ratio, only rounded; ``incident_rate`` is per
    person, and ``population`` is what the unrounded rate implies. Of rows that
    repeat a place and day ``collapse`` keeps one before the windows, whole: the one with the
    greatest confirmed count (``latest_rows``); without it their order is arbitrary. ``last_day`` is
    the newest day of the rows that stay, where that is known at less cost than by reading them again.
    """
    rows = union_sources(
        report_rows(us, F.col("province_state") != NOT_A_STATE, day, tested=True),
        report_rows(world, F.col("country_region") != US_COUNTRY, day, tested=False),
    )
    newest = rows.agg(F.max("dt")).scalar() if last_day is None else last_day
    if collapse:
        rows = latest_rows(rows, GLOBAL_SERIES_KEY, ["total_confirmed"])
    population = implied_population(F.col("total_confirmed"), F.col("incident_rate"))
    return (
        series_metrics(rows.withColumn("population", population), GLOBAL_SERIES_KEY, DAILY_METRICS)
        .withColumns(
            {
                "incident_rate": F.round("incident_rate", RATE_DIGITS),
                "last_updated_dt": newest,
                "last_updated_ts": local_stamp(now),
            }
        )
        .select(
            "dt",
            *GLOBAL_PLACE,
            "population",
            *[f"total_{m}" for m in DAILY_METRICS],
            *[f"daily_new_{m}" for m in DAILY_METRICS],
            *_averages(DAILY_METRICS),
            "incident_rate",
            "case_fatality_rate",
            "total_test_results",
            "testing_rate",
            "last_updated_dt",
            "last_updated_ts",
        )
    )


def _aligned_world(
    confirmed: DataFrame, deaths: DataFrame, recovered: DataFrame, coalesce_keys: bool
) -> DataFrame:
    return align_wide(
        dict(zip(WIDE_METRICS, (confirmed, deaths, recovered))),
        on=GLOBAL_SERIES_KEY,
        describe=GLOBAL_PLACE,
        null_tolerant=("province_state",),
        coalesce_keys=coalesce_keys,
    )


def global_series_wide(
    confirmed: DataFrame,
    deaths: DataFrame,
    recovered: DataFrame,
    coalesce_keys: bool = True,
    now: Instant = None,
    states: DataFrame | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """Three-metric series from the wide frames.

    The wide frames hold no population, so there is no incident rate unless ``population`` is
    given: ``(dt, *key, population)``, of which a row takes the latest that is not later. Then the
    result has ``population`` and ``incident_rate`` (per person). ``states`` adds rows of places that
    the wide frames know as a whole only, such as ``state_rollup`` gives them: ``dt``, key, and those
    totals that they have; a missing total is 0. Their keys must not be in the wide frames.

    ``coalesce_keys=False`` puts a key that confirmed lacks on two rows per day; they are
    merged before the windows, which need one row per day.
    """
    axes = [date_columns(df.columns) for df in (confirmed, deaths, recovered)]
    aligned = _aligned_world(confirmed, deaths, recovered, coalesce_keys)
    if not coalesce_keys:
        aligned = collapse_days(aligned, GLOBAL_SERIES_KEY)
    if states is not None:
        known = [f"total_{m}" for m in WIDE_METRICS if f"total_{m}" in states.columns]
        rows = states.select("dt", *GLOBAL_SERIES_KEY, *known)
        aligned = union_drifted(aligned, rows).fillna(0, [f"total_{m}" for m in WIDE_METRICS])
    added = []
    if population is not None:
        aligned = asof_enrich(aligned, population, GLOBAL_SERIES_KEY, ["population"])
        added = ["population"]
    if states is None and axes[0] == axes[1] == axes[2]:
        last_day = F.lit(column_day(axes[0][-1]))
    else:
        last_day = aligned.agg(F.max("dt")).scalar()
    return (
        series_metrics(aligned, GLOBAL_SERIES_KEY, WIDE_METRICS, filled=True)
        .withColumns(
            {
                "case_fatality_rate": safe_ratio(F.col("total_deaths"), F.col("total_confirmed")),
                "last_updated_dt": last_day,
                "last_updated_ts": local_stamp(now),
            }
            | {"incident_rate": safe_ratio(F.col("total_confirmed"), F.col(c)) for c in added}
        )
        .select(
            "dt",
            *GLOBAL_PLACE,
            *added,
            *[f"total_{m}" for m in WIDE_METRICS],
            *[f"daily_new_{m}" for m in WIDE_METRICS],
            *_averages(WIDE_METRICS),
            *["incident_rate" for _ in added],
            "case_fatality_rate",
            "last_updated_dt",
            "last_updated_ts",
        )
    )


def global_series_basic(
    confirmed: DataFrame,
    deaths: DataFrame,
    recovered: DataFrame,
    coalesce_keys: bool = True,
    now: Instant = None,
) -> DataFrame:
    """The older shape: totals, new counts and the stamp, without averages."""
    aligned = _aligned_world(confirmed, deaths, recovered, coalesce_keys)
    if not coalesce_keys:
        aligned = collapse_days(aligned, GLOBAL_SERIES_KEY)
    window = series_window(GLOBAL_SERIES_KEY)
    named = aligned.withColumnsRenamed({f"total_{m}": m for m in WIDE_METRICS})
    return named.select(
        "dt",
        *GLOBAL_PLACE,
        *WIDE_METRICS,
        *[
            first_row_fallback(delta(F.col(m), window), F.col(m)).alias(f"{m}_new")
            for m in WIDE_METRICS
        ],
        local_stamp(now).alias("last_updated_ts"),
    )

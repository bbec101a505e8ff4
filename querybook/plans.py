"""The composite plans. Run stamps are left out: they differ from run to run."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from casetrends.operators import series_metrics, unpivot_wide
from casetrends.plans import (
    global_series_basic,
    global_series_daily,
    global_series_wide,
    ingest_daily_reports,
    refresh_series,
    state_rollup,
    us_current,
    us_series,
    us_series_from_long,
)
from casetrends.schemas import GLOBAL_DAILY
from casetrends.sources import replace_partitions
from querybook.registry import query
from querybook.storage import SQL_STANDARD_REPORTS, report_folder, scratch_table
from querybook.views import (
    SQL_AXIS,
    SQL_NATION_DAYS,
    SQL_ORDER_DAYS,
    SQL_PLACES,
    SQL_REPORT_TEXTS,
    SQL_REPORTS,
    event_days_range,
    global_wide,
    last_report_day,
    order_dates,
    places,
    reports,
    sql_global_long_of_wide,
    sql_round,
    sql_us_long,
    sql_us_long_of_wide,
    table,
    us_long,
    us_reports,
    us_wide,
    with_ctes,
)


def sql_series(source: str, key: str, metrics: tuple[str, ...], prefix: str = "fresh") -> str:
    """CTE ``fresh``: ``source`` plus new counts."""
    new = ",\n           ".join(
        f"COALESCE(total_{m} - LAG(total_{m}) OVER w, total_{m}) AS daily_new_{m}" for m in metrics
    )
    return f"""
{prefix} AS (
    SELECT *, {new}
    FROM {source}
    WINDOW w AS (PARTITION BY {key} ORDER BY dt)
)"""


def sql_averages(key: str, metrics: tuple[str, ...]) -> str:
    return ",\n       ".join(
        sql_round(
            f"AVG(daily_new_{m}) OVER (PARTITION BY {key} ORDER BY dt "
            f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)",
            1,
        )
        + f" AS daily_new_{m}_{n}d_ma"
        for n in (7, 28)
        for m in metrics
    )


US = ("confirmed", "deaths")
US_DESCRIBE = ("county", "province_state", "country_region", "latitude", "longitude")
IDS = "county, province_state, country_region, combined_key, latitude, longitude"


def sql_us_joined(confirmed: str, deaths: str, population: str) -> str:
    described = ",\n               ".join(f"COALESCE(a.{c}, b.{c}) AS {c}" for c in US_DESCRIBE)
    return f"""
joined AS (
    SELECT j.*, p.population
    FROM (
        SELECT COALESCE(a.dt, b.dt) AS dt, COALESCE(a.combined_key, b.combined_key) AS combined_key,
               {described},
               COALESCE(total_confirmed, 0) AS total_confirmed,
               COALESCE(total_deaths, 0) AS total_deaths
        FROM {confirmed} a FULL JOIN {deaths} b
          ON a.dt = b.dt AND a.combined_key = b.combined_key
    ) j
    LEFT JOIN {population} p ON j.combined_key = p.combined_key
)"""


SQL_US_RESULT = f"""
us_series AS (
    SELECT dt, {IDS}, population, total_confirmed, total_deaths,
           daily_new_confirmed, daily_new_deaths,
           {sql_averages("combined_key", US)},
           CASE WHEN population = 0 THEN NULL
                ELSE {sql_round("total_confirmed / population", 4)} END AS incident_rate,
           CASE WHEN total_confirmed = 0 THEN NULL
                ELSE {sql_round("total_deaths / total_confirmed", 4)} END AS case_fatality_rate,
           MAX(dt) OVER () AS last_updated_dt
    FROM fresh
)"""

SQL_US_WIDE = with_ctes(
    SQL_PLACES,
    SQL_AXIS,
    sql_us_long_of_wide("confirmed"),
    sql_us_long_of_wide("deaths"),
    sql_us_joined(
        "us_confirmed_melted",
        "us_deaths_melted",
        "(SELECT DISTINCT combined_key, population FROM us_deaths_melted)",
    ),
    sql_series("joined", "combined_key", US),
    SQL_US_RESULT,
)


@query("Q1_us_series", SQL_US_WIDE + "SELECT * FROM us_series")
def q1(spark, sf):
    series = us_series(us_wide(spark, sf, "confirmed"), us_wide(spark, sf, "deaths"))
    return series.drop("last_updated_ts")


@query("Q1_us_series_one_row_per_place", SQL_US_WIDE + "SELECT * FROM us_series")
def q1_unique(spark, sf):
    wides = us_wide(spark, sf, "confirmed"), us_wide(spark, sf, "deaths")
    return us_series(*wides, one_row_per_place=True).drop("last_updated_ts")


SQL_US_LONG = with_ctes(
    SQL_ORDER_DAYS,
    SQL_PLACES,
    sql_us_long("confirmed"),
    sql_us_long("deaths"),
    sql_us_joined("us_confirmed", "us_deaths", "places"),
    sql_series("joined", "combined_key", US),
    SQL_US_RESULT,
) + "SELECT * FROM us_series"


def _from_long(spark, sf, one_row_per_day):
    # Every order of a known place counts as confirmed, so the last of them has the last day.
    series = us_series_from_long(
        us_long(spark, sf, "confirmed"),
        us_long(spark, sf, "deaths"),
        places(spark, sf),
        one_row_per_day=one_row_per_day,
        over=order_dates(spark, sf),
    )
    return series.drop("last_updated_ts")


@query("Q1_us_series_from_long", SQL_US_LONG)
def q1_long(spark, sf):
    return _from_long(spark, sf, one_row_per_day=False)


@query("Q1_us_series_from_long_stacked", SQL_US_LONG)
def q1_long_stacked(spark, sf):
    return _from_long(spark, sf, one_row_per_day=True)


@query("Q2_us_current", SQL_US_WIDE + "SELECT * FROM us_series WHERE dt = last_updated_dt")
def q2(spark, sf):
    current = us_current(us_wide(spark, sf, "confirmed"), us_wide(spark, sf, "deaths"))
    return current.drop("last_updated_ts")


@query(
    "Q2_us_current_one_row_per_place",
    SQL_US_WIDE + "SELECT * FROM us_series WHERE dt = last_updated_dt",
)
def q2_unique(spark, sf):
    wides = us_wide(spark, sf, "confirmed"), us_wide(spark, sf, "deaths")
    return us_current(*wides, one_row_per_place=True).drop("last_updated_ts")


SINCE = 6


@query(
    "Q1_refresh_corrected_days",
    with_ctes(
        SQL_PLACES,
        SQL_AXIS,
        sql_us_long_of_wide("confirmed"),
        f"""
corrected AS (
    SELECT dt, combined_key, CASE WHEN dt > (SELECT MAX(dt) FROM axis) - {SINCE} AND "UID" % 3 = 0
                                  THEN total_confirmed * 2 ELSE total_confirmed END AS total_confirmed
    FROM us_confirmed_melted
)""",
        sql_series("corrected", "combined_key", ("confirmed",)),
    )
    + f"""SELECT dt, combined_key, total_confirmed, daily_new_confirmed,
                 {sql_averages("combined_key", ("confirmed",))} FROM fresh""",
)
def q1_refresh(spark, sf):
    """A stored series, then corrected last days: only these are computed and written again."""
    table_name = scratch_table(spark, "series")
    long = unpivot_wide(us_wide(spark, sf, "confirmed"), ["UID", "combined_key"], "confirmed")
    stored = series_metrics(long.drop("UID"), ["combined_key"], ["confirmed"])
    replace_partitions(stored, table_name, "dt")
    since = event_days_range(spark, sf)[1] - timedelta(days=SINCE - 1)
    twice = F.when(F.col("UID") % 3 == 0, F.col("total_confirmed") * 2)
    fresh = (
        long.filter(F.col("dt") >= F.lit(since))
        .withColumn("total_confirmed", F.coalesce(twice, "total_confirmed"))
        .drop("UID")
    )
    refresh_series(spark, table_name, fresh, ["combined_key"], ["confirmed"], since)
    return spark.table(table_name)


WORLD = ("confirmed", "deaths", "recovered", "active")
WORLD_KEY = "province_state, country_region"


def _sql_report_branch(source: str, keep: str, tests: str) -> str:
    return f"""SELECT report_dt AS dt, province_state, country_region, latitude, longitude,
           confirmed AS total_confirmed, deaths AS total_deaths, recovered AS total_recovered,
           active AS total_active,
           CASE WHEN incident_rate > 100000 THEN NULL ELSE incident_rate / 100000 END AS incident_rate,
           {sql_round("case_fatality_ratio", 4)} AS case_fatality_rate,
           {tests}
    FROM {source} WHERE {keep}"""


_TESTED = "total_test_results, " + sql_round(
    "CASE WHEN testing_rate > 100000 THEN NULL ELSE testing_rate / 100000 END", 4
) + " AS testing_rate"

SQL_REPORT_UNION = f"""
both_reports AS (
    {_sql_report_branch("us_reports", "province_state <> 'Recovered'", _TESTED)}
    UNION ALL
    {_sql_report_branch("reports", "country_region <> 'US'",
                        "NULL AS total_test_results, NULL AS testing_rate")}
)"""


@query(
    "Q3_global_series_daily",
    with_ctes(
        SQL_NATION_DAYS,
        SQL_REPORTS,
        SQL_REPORT_UNION,
        sql_series("both_reports", WORLD_KEY, WORLD),
    )
    + f"""SELECT dt, {WORLD_KEY}, latitude, longitude,
                 CAST(ROUND(CASE WHEN incident_rate = 0 THEN NULL
                                 ELSE total_confirmed / incident_rate END) AS BIGINT) AS population,
                 {", ".join(f"total_{m}" for m in WORLD)},
                 {", ".join(f"daily_new_{m}" for m in WORLD)},
                 {sql_averages(WORLD_KEY, WORLD)},
                 {sql_round("incident_rate", 4)} AS incident_rate, case_fatality_rate,
                 total_test_results, testing_rate, MAX(dt) OVER () AS last_updated_dt
          FROM fresh""",
)
def q3(spark, sf):
    newest = last_report_day(spark, sf)
    series = global_series_daily(us_reports(spark, sf), reports(spark, sf), last_day=newest)
    return series.drop("last_updated_ts")


WIDE = ("confirmed", "deaths", "recovered")
PLACE = "province_state, country_region, latitude, longitude"


def _sql_world_joined() -> str:
    merged = ", ".join(
        f"COALESCE(a.{c}, b.{c}, c.{c}) AS {c}"
        for c in ("dt", "province_state", "country_region", "latitude", "longitude")
    )
    return f"""
joined AS (
    SELECT {merged}, {", ".join(f"COALESCE(total_{m}, 0) AS total_{m}" for m in WIDE)}
    FROM confirmed_long a
    FULL JOIN deaths_long b
      ON a.dt = b.dt AND COALESCE(a.province_state, '') = COALESCE(b.province_state, '')
     AND a.country_region = b.country_region
    FULL JOIN recovered_long c
      ON COALESCE(a.dt, b.dt) = c.dt
     AND COALESCE(a.province_state, b.province_state, '') = COALESCE(c.province_state, '')
     AND COALESCE(a.country_region, b.country_region) = c.country_region
)"""


SQL_WORLD_WIDE = with_ctes(
    SQL_AXIS,
    *[sql_global_long_of_wide(m, f"{m}_long") for m in WIDE],
    _sql_world_joined(),
    sql_series("joined", WORLD_KEY, WIDE),
)


@query(
    "Q4_global_series_wide",
    SQL_WORLD_WIDE
    + f"""SELECT dt, {PLACE}, {", ".join(f"total_{m}" for m in WIDE)},
                 {", ".join(f"daily_new_{m}" for m in WIDE)},
                 {sql_averages(WORLD_KEY, WIDE)},
                 CASE WHEN total_confirmed = 0 THEN NULL
                      ELSE {sql_round("total_deaths / total_confirmed", 4)} END AS case_fatality_rate,
                 MAX(dt) OVER () AS last_updated_dt
          FROM fresh""",
)
def q4(spark, sf):
    series = global_series_wide(*[global_wide(spark, sf, m) for m in WIDE])
    return series.drop("last_updated_ts")


US_STATES = "US states of "

SQL_WITH_STATES = with_ctes(
    SQL_PLACES,
    SQL_AXIS,
    sql_us_long_of_wide("confirmed"),
    sql_us_long_of_wide("deaths"),
    sql_us_joined(
        "us_confirmed_melted",
        "us_deaths_melted",
        "(SELECT DISTINCT combined_key, population FROM us_deaths_melted)",
    ).replace("joined AS", "us_joined AS", 1),
    f"""
states AS (
    SELECT dt, province_state, country_region AS country, '{US_STATES}' || country_region AS country_region,
           SUM(population) AS population, SUM(total_confirmed) AS total_confirmed,
           SUM(total_deaths) AS total_deaths
    FROM us_joined GROUP BY ALL
),
people AS (
    SELECT dt, province_state, unnest([country, country_region]) AS country_region, population
    FROM states WHERE day(dt) % 5 = 0
)""",
    *[sql_global_long_of_wide(m, f"{m}_long") for m in WIDE],
    _sql_world_joined(),
    """
rows AS (
    SELECT * FROM joined
    UNION ALL BY NAME
    SELECT dt, province_state, country_region, CAST(total_confirmed AS BIGINT) AS total_confirmed,
           CAST(total_deaths AS BIGINT) AS total_deaths, CAST(0 AS BIGINT) AS total_recovered FROM states
),
peopled AS (
    SELECT r.*, CAST(p.population AS BIGINT) AS population
    FROM rows r ASOF LEFT JOIN people p
      ON COALESCE(r.province_state, '') = COALESCE(p.province_state, '')
     AND r.country_region = p.country_region AND r.dt >= p.dt
)""",
    sql_series("peopled", WORLD_KEY, WIDE),
)


@query(
    "Q4_global_series_with_states",
    SQL_WITH_STATES
    + f"""SELECT dt, {PLACE}, population, {", ".join(f"total_{m}" for m in WIDE)},
                 {", ".join(f"daily_new_{m}" for m in WIDE)},
                 {sql_averages(WORLD_KEY, WIDE)},
                 CASE WHEN population = 0 THEN NULL
                      ELSE {sql_round("total_confirmed / population", 4)} END AS incident_rate,
                 CASE WHEN total_confirmed = 0 THEN NULL
                      ELSE {sql_round("total_deaths / total_confirmed", 4)} END AS case_fatality_rate,
                 MAX(dt) OVER () AS last_updated_dt
          FROM fresh""",
)
def q4_states(spark, sf):
    """States rolled up from counties beside the nations; populations known on every fifth day."""
    counties = us_series(us_wide(spark, sf, "confirmed"), us_wide(spark, sf, "deaths"))
    states = state_rollup(counties)
    named = states.withColumn("country_region", F.concat(F.lit(US_STATES), "country_region"))
    people = states.unionByName(named).filter(F.day("dt") % 5 == 0)
    series = global_series_wide(
        *[global_wide(spark, sf, m) for m in WIDE], states=named,
        population=people.select("dt", "province_state", "country_region", "population"),
    )
    return series.drop("last_updated_ts")


@query(
    "Q5_global_series_basic",
    SQL_WORLD_WIDE
    + f"""SELECT dt, {PLACE}, {", ".join(f"total_{m} AS {m}" for m in WIDE)},
                 {", ".join(f"daily_new_{m} AS {m}_new" for m in WIDE)}
          FROM fresh""",
)
def q5(spark, sf):
    series = global_series_basic(*[global_wide(spark, sf, m) for m in WIDE])
    return series.drop("last_updated_ts")


@query(
    "Q6_ingest_daily_reports",
    with_ctes(SQL_REPORT_TEXTS) + SQL_STANDARD_REPORTS,
)
def q6(spark, sf):
    base, name = report_folder(spark, sf), scratch_table(spark, "daily_global")
    ingest_daily_reports(spark, base, name, GLOBAL_DAILY, *event_days_range(spark, sf))
    return spark.table(name).withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))


@query(
    "Q7_state_rollup",
    SQL_US_WIDE
    + """SELECT dt, province_state, country_region, CAST(SUM(population) AS BIGINT) AS population,
                CAST(SUM(total_confirmed) AS BIGINT) AS total_confirmed,
                CAST(SUM(total_deaths) AS BIGINT) AS total_deaths
         FROM us_series GROUP BY dt, province_state, country_region""",
)
def q7(spark, sf):
    return state_rollup(us_series(us_wide(spark, sf, "confirmed"), us_wide(spark, sf, "deaths")))

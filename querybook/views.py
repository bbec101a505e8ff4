"""Case-count frames out of the driver's tables, in Spark and as SQL text.

Places: a customer is a county, its nation the province or state, the region the country.
``NATION_0`` has no province name. Counts: events per user and day (wide frames, a column for
every day from the first event to the last) and orders per customer or nation and day (2,400
sparse days, long frames).

Orders and events are counted per customer and day before they meet the customer table, so a
customer with very many rows is already reduced to at most one row per day by then. Small
tables are not hinted: the planner broadcasts them only while it knows them to be small.
"""

from __future__ import annotations

import datetime as dt
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casetrends.functions.dates import column_day, day_column
from casetrends.operators.series import series_window

# --- small helpers ------------------------------------------------------------------------


_OPENED: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table; its listing and schema are looked up once per session."""
    opened = _OPENED.setdefault(spark, {})
    path = f"{sf}/{name}.parquet"
    if path not in opened:
        opened[path] = spark.read.parquet(path)
    return opened[path]


def sql_round(expr: str, digits: int) -> str:
    """Round as Spark does: on the shortest decimal text of the double, halves away from zero."""
    return f"CAST(ROUND(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


def sql_long(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


# --- wide frames from events ----------------------------------------------------------------

# Which event types count for a metric.
EVENTS_OF = {
    "confirmed": ("view", "click", "signup"),
    "deaths": ("error",),
    "recovered": ("purchase",),
}

US_IDS = [
    "UID",
    "iso2",
    "iso3",
    "code3",
    "FIPS",
    "county",
    "province_state",
    "country_region",
    "latitude",
    "longitude",
    "combined_key",
]


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer as a described county."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("place_id"),
            F.col("c_name").alias("county"),
            F.col("n_name").alias("province_state"),
            F.col("r_name").alias("country_region"),
            F.col("n_nationkey").cast("double").alias("latitude"),
            F.col("r_regionkey").cast("double").alias("longitude"),
            F.concat_ws(", ", "c_name", "n_name", "r_name").alias("combined_key"),
            F.floor("c_acctbal").cast("bigint").alias("population"),
        )
    )


SQL_PLACES = """
places AS (
    SELECT c_custkey AS place_id, c_name AS county, n_name AS province_state,
           r_name AS country_region, CAST(n_nationkey AS DOUBLE) AS latitude,
           CAST(r_regionkey AS DOUBLE) AS longitude,
           c_name || ', ' || n_name || ', ' || r_name AS combined_key,
           CAST(FLOOR(c_acctbal) AS BIGINT) AS population
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""


_RANGES: WeakKeyDictionary[SparkSession, dict[str, tuple]] = WeakKeyDictionary()


def event_days_range(spark: SparkSession, sf: str) -> tuple[dt.date, dt.date]:
    """The first and the last day that has events; one aggregate per session and table."""
    known = _RANGES.setdefault(spark, {})
    if sf not in known:
        day = F.col("ts").cast("date")
        known[sf] = tuple(table(spark, sf, "events").agg(F.min(day), F.max(day)).first())
    return known[sf]


def day_columns(spark: SparkSession, sf: str) -> list[str]:
    """A date column for every day from the first event to the last."""
    first, last = event_days_range(spark, sf)
    if first is None:
        return []
    return [day_column(first + dt.timedelta(days=i)) for i in range((last - first).days + 1)]


def _user_days(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    """A metric's events per user and day: a user's very many events become one row per day."""
    counted = table(spark, sf, "events").filter(F.col("event_type").isin(*EVENTS_OF[metric]))
    return counted.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(
        F.count("*").alias("n")
    )


def _running(per_day: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key with the running sum of ``n`` in each date column; NULL before the first.

    The sum of a day is repeated up to the next day that has one, and these runs joined end to
    end, so the work grows with the days, not with their square.
    """
    if not columns:
        return per_day.select(*keys).distinct()
    by_day = Window.partitionBy(*keys).orderBy("day")
    at = F.date_diff("day", F.lit(column_day(columns[0])))
    placed = per_day.select(
        *keys, at.alias("at"), F.sum("n").over(by_day).alias("total"),
        F.coalesce(F.lead(at).over(by_day), F.lit(len(columns))).alias("until"),
    )
    run = F.array_repeat("total", F.col("until") - F.col("at"))
    rows = placed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("at", run.alias("run")))).alias("runs"))
    before = F.array_repeat(F.lit(None).cast("bigint"), F.col("runs")[0]["at"])
    totals = rows.select(
        *keys, F.concat(before, F.flatten(F.transform("runs", lambda r: r["run"]))).alias("totals")
    )
    return totals.select(*keys, *[F.col("totals")[k].alias(c) for k, c in enumerate(columns)])


SQL_AXIS = """
axis AS (
    SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dt
    FROM (SELECT date_trunc('day', MIN(ts)) AS lo, date_trunc('day', MAX(ts)) AS hi FROM events)
)"""


def _sql_running(metric: str, source: str, keys: tuple[str, ...]) -> str:
    """Long rows: every key with every day of the axis and the count up to it."""
    kinds = ", ".join(f"'{k}'" for k in EVENTS_OF[metric])
    names = ", ".join(keys)
    same = " AND ".join(f"g.{k} IS NOT DISTINCT FROM d.{k}" for k in keys)
    total = sql_long(f"SUM(n) OVER (PARTITION BY {', '.join('g.' + k for k in keys)} ORDER BY g.dt)")
    return f"""SELECT {", ".join("g." + k for k in keys)}, g.dt, {total} AS total_{metric}
    FROM (SELECT DISTINCT {names}, axis.dt FROM {source}, axis WHERE event_type IN ({kinds})) g
    LEFT JOIN (SELECT {names}, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM {source}
               WHERE event_type IN ({kinds}) GROUP BY ALL) d
      ON {same} AND g.dt = d.day"""


def us_wide(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    """County wide frame: running event counts; NULL before a county's first event."""
    columns = day_columns(spark, sf)
    counts = _running(_user_days(spark, sf, metric), ["user_id"], columns)
    located = counts.join(places(spark, sf), F.col("user_id") == F.col("place_id"))
    extra = ["population"] if metric == "deaths" else []
    return located.select(
        F.col("user_id").alias("UID"),
        F.lit("US").alias("iso2"),
        F.lit("USA").alias("iso3"),
        F.lit(840).cast("bigint").alias("code3"),
        F.col("user_id").alias("FIPS"),
        "county",
        "province_state",
        "country_region",
        "latitude",
        "longitude",
        "combined_key",
        *extra,
        *columns,
    )


def sql_us_long_of_wide(metric: str) -> str:
    """The wide frame's rows, melted: ``us_<metric>_melted``."""
    extra = "population, " if metric == "deaths" else ""
    return f"""
us_{metric}_counts AS (
    {_sql_running(metric, "events", ("user_id",))}
),
us_{metric}_melted AS (
    SELECT user_id AS "UID", 'US' AS iso2, 'USA' AS iso3, CAST(840 AS BIGINT) AS code3,
           user_id AS "FIPS", county, province_state, country_region, latitude, longitude,
           combined_key, {extra}dt, total_{metric}
    FROM us_{metric}_counts JOIN places ON user_id = place_id
)"""


def nation_name() -> Column:
    return F.when(F.col("n_name") != "NATION_0", F.col("n_name"))


def global_wide(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    """Nation wide frame. Recovered cases of ASIA are known for the country only."""
    name, spot = "nullif(n_name, 'NATION_0')", "CAST(n_nationkey AS double)"
    if metric == "recovered":
        name, spot = (f"CASE WHEN r_name <> 'ASIA' THEN {v} END" for v in (name, spot))
    keys = ["province_state", "country_region", "latitude", "longitude"]
    per_day = (
        _user_days(spark, sf, metric)
        .join(table(spark, sf, "customer"), F.col("user_id") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(
            F.expr(name).alias("province_state"),
            F.col("r_name").alias("country_region"),
            F.expr(spot).alias("latitude"),
            F.col("r_regionkey").cast("double").alias("longitude"),
            "day",
        )
        .agg(F.sum("n").alias("n"))
    )
    return _running(per_day, keys, day_columns(spark, sf))


def sql_global_long_of_wide(metric: str, name: str) -> str:
    whole = metric == "recovered"
    state = "NULLIF(n_name, 'NATION_0')"
    spot = "CAST(n_nationkey AS DOUBLE)"
    if whole:
        state = f"CASE WHEN r_name <> 'ASIA' THEN {state} END"
        spot = f"CASE WHEN r_name <> 'ASIA' THEN {spot} END"
    keys = ("province_state", "country_region", "latitude", "longitude")
    return f"""
placed_{metric} AS (
    SELECT event_type, ts, {state} AS province_state, r_name AS country_region,
           {spot} AS latitude, CAST(r_regionkey AS DOUBLE) AS longitude
    FROM events
    JOIN customer ON user_id = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
),
{name} AS (
    {_sql_running(metric, f"placed_{metric}", keys)}
)"""


# --- long frames from orders ------------------------------------------------------------------

STATUS_OF = {"confirmed": ("F", "O", "P"), "deaths": ("F",), "recovered": ("O",), "active": ("P",)}


def order_days(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per customer, day and status."""
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("dt"))
        .agg(
            *[
                F.count_if(F.col("o_orderstatus").isin(*kinds)).alias(f"new_{metric}")
                for metric, kinds in STATUS_OF.items()
            ]
        )
    )


def _sql_status_counts() -> str:
    return ", ".join(
        "COUNT(*) FILTER (WHERE o_orderstatus IN ({})) AS new_{}".format(
            ", ".join(f"'{k}'" for k in kinds), metric
        )
        for metric, kinds in STATUS_OF.items()
    )


SQL_ORDER_DAYS = f"""
order_days AS (
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS dt, {_sql_status_counts()}
    FROM orders
    GROUP BY ALL
)"""


def order_dates(spark: SparkSession, sf: str) -> DataFrame:
    """The days of all orders that belong to a place, without grouping them."""
    known = places(spark, sf).select("place_id")
    orders = table(spark, sf, "orders")
    located = orders.join(known, F.col("o_custkey") == F.col("place_id"), "left_semi")
    return located.select(F.col("o_orderdate").cast("date").alias("dt"))


def us_long(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    """County long frame: running order counts on the days that add to the metric."""
    fresh = order_days(spark, sf).filter(F.col(f"new_{metric}") > 0)
    total = F.sum(f"new_{metric}").over(series_window(["o_custkey"]))
    running = fresh.select("o_custkey", "dt", total.alias(f"total_{metric}"))
    located = running.join(places(spark, sf), F.col("o_custkey") == F.col("place_id"))
    return located.select(
        "dt",
        "county",
        "province_state",
        "country_region",
        "combined_key",
        "latitude",
        "longitude",
        f"total_{metric}",
    )


def sql_us_long(metric: str) -> str:
    return f"""
us_{metric} AS (
    SELECT dt, county, province_state, country_region, combined_key, latitude, longitude,
           CAST(SUM(new_{metric}) OVER (PARTITION BY o_custkey ORDER BY dt) AS BIGINT)
               AS total_{metric}
    FROM order_days JOIN places ON o_custkey = place_id
    WHERE new_{metric} > 0
)"""


def nation_days(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per nation, day and status."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        order_days(spark, sf)
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("dt", "c_nationkey")
        .agg(*[F.sum(f"new_{m}").alias(f"new_{m}") for m in STATUS_OF])
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "dt",
            "n_nationkey",
            "n_name",
            "r_name",
            nation_name().alias("province_state"),
            F.col("r_name").alias("country_region"),
            F.col("n_nationkey").cast("double").alias("latitude"),
            F.col("r_regionkey").cast("double").alias("longitude"),
            *[f"new_{m}" for m in STATUS_OF],
        )
    )


SQL_NATION_DAYS = f"""
nation_days AS (
    SELECT CAST(o_orderdate AS DATE) AS dt, n_nationkey, n_name, r_name,
           NULLIF(n_name, 'NATION_0') AS province_state, r_name AS country_region,
           CAST(n_nationkey AS DOUBLE) AS latitude, CAST(r_regionkey AS DOUBLE) AS longitude,
           {_sql_status_counts()}
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
)"""


def global_long(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    """Nation long frame: running order counts on the days that add to the metric."""
    fresh = nation_days(spark, sf).filter(F.col(f"new_{metric}") > 0)
    # The labels are part of the key (one of each in a nation), so filters on them pass the window.
    window = series_window(["n_nationkey", "province_state", "country_region"])
    total = F.sum(f"new_{metric}").over(window)
    return fresh.select(
        "dt",
        "province_state",
        "country_region",
        "latitude",
        "longitude",
        total.alias(f"total_{metric}"),
    )


def sql_global_long(metric: str) -> str:
    return f"""
global_{metric} AS (
    SELECT dt, province_state, country_region, latitude, longitude,
           CAST(SUM(new_{metric}) OVER (PARTITION BY n_nationkey ORDER BY dt) AS BIGINT)
               AS total_{metric}
    FROM nation_days
    WHERE new_{metric} > 0
)"""


# --- daily report tables from orders ----------------------------------------------------------


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """One row per nation and day in the shape of the daily report tables.

    AMERICA is the US, NATION_6 in it a row labelled Recovered. The population is the number
    of customers, so rates of nations with more orders than customers are implausible.
    """
    people = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("people"))
    days = nation_days(spark, sf).join(people, F.col("n_nationkey") == F.col("c_nationkey"))
    labelled = days.withColumns(
        {
            "province_state": F.when(F.col("n_name") == "NATION_6", F.lit("Recovered"))
            .otherwise(F.col("province_state")),
            "country_region": F.when(F.col("r_name") == "AMERICA", F.lit("US"))
            .otherwise(F.col("r_name")),
        }
    )
    # The labels are part of the key (one of each in a nation), so filters on them pass the window.
    window = series_window(["n_nationkey", "province_state", "country_region"], "dt")
    totals = labelled.select(
        F.col("dt").alias("report_dt"),
        "province_state",
        "country_region",
        "latitude",
        "longitude",
        *[F.sum(f"new_{m}").over(window).alias(m) for m in STATUS_OF],
        "people",
    )
    confirmed = F.col("confirmed")
    return totals.select(
        "report_dt",
        "province_state",
        "country_region",
        "latitude",
        "longitude",
        *STATUS_OF,
        (confirmed * F.lit(1e5) / F.col("people")).alias("incident_rate"),
        (F.col("deaths") * F.lit(1e2) / confirmed).alias("case_fatality_ratio"),
        (confirmed * 3).alias("total_test_results"),
        (confirmed * F.lit(3e5) / F.col("people")).alias("testing_rate"),
    )


def last_report_day(spark: SparkSession, sf: str) -> Column:
    """The newest day of the reports that are neither of the US without a state nor labelled
    Recovered there, from the orders alone: a day with an order is a day with a report."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    kept = (F.col("r_name") != "AMERICA") | ~F.col("n_name").isin("NATION_0", "NATION_6")
    known = table(spark, sf, "customer").join(
        nation.filter(kept), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    )
    orders = table(spark, sf, "orders")
    located = orders.join(known, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    return located.agg(F.max(F.col("o_orderdate").cast("date"))).scalar()


def us_reports(spark: SparkSession, sf: str) -> DataFrame:
    return reports(spark, sf).filter(F.col("country_region") == "US")


SQL_REPORTS = """
people AS (SELECT c_nationkey, COUNT(*) AS people FROM customer GROUP BY c_nationkey),
report_totals AS (
    SELECT dt AS report_dt,
           CASE WHEN n_name = 'NATION_6' THEN 'Recovered' ELSE province_state END AS province_state,
           CASE WHEN r_name = 'AMERICA' THEN 'US' ELSE r_name END AS country_region,
           latitude, longitude,
           CAST(SUM(new_confirmed) OVER w AS BIGINT) AS confirmed,
           CAST(SUM(new_deaths) OVER w AS BIGINT) AS deaths,
           CAST(SUM(new_recovered) OVER w AS BIGINT) AS recovered,
           CAST(SUM(new_active) OVER w AS BIGINT) AS active,
           people
    FROM nation_days JOIN people ON n_nationkey = c_nationkey
    WINDOW w AS (PARTITION BY n_nationkey ORDER BY dt)
),
reports AS (
    SELECT report_dt, province_state, country_region, latitude, longitude,
           confirmed, deaths, recovered, active,
           confirmed * CAST(1e5 AS DOUBLE) / people AS incident_rate,
           deaths * CAST(1e2 AS DOUBLE) / confirmed AS case_fatality_ratio,
           confirmed * 3 AS total_test_results,
           confirmed * CAST(3e5 AS DOUBLE) / people AS testing_rate
    FROM report_totals
),
us_reports AS (SELECT * FROM reports WHERE country_region = 'US')"""

# --- daily report files from events -------------------------------------------------------------

# From this day on the files have the later spellings and one column more.
NEW_HEADER_DAY = dt.date(2024, 1, 16)


def report_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Events per nation and day under neutral names, for writing report files."""
    events = table(spark, sf, "events")
    per_user = events.groupBy("user_id", F.col("ts").cast("date").alias("report_dt")).agg(
        F.count("*").alias("confirmed"),
        F.count_if(F.col("event_type") == "error").alias("deaths"),
        F.count_if(F.col("event_type") == "purchase").alias("recovered"),
        F.max("ts").alias("seen"),
    )
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        per_user.join(table(spark, sf, "customer"), F.col("user_id") == F.col("c_custkey"))
        .groupBy("report_dt", "c_nationkey")
        .agg(
            F.sum("confirmed").alias("confirmed"),
            F.sum("deaths").alias("deaths"),
            F.sum("recovered").alias("recovered"),
            F.max("seen").alias("seen"),
        )
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "report_dt",
            nation_name().alias("province_state"),
            F.col("r_name").alias("country_region"),
            F.date_trunc("second", "seen").cast("timestamp_ntz").alias("last_update"),
            F.col("n_nationkey").cast("double").alias("latitude"),
            F.col("n_regionkey").cast("double").alias("longitude"),
            "confirmed",
            "deaths",
            "recovered",
            (F.col("confirmed") - F.col("deaths")).alias("active"),
        )
    )


SQL_REPORT_TEXTS = """
report_texts AS (
    SELECT CAST(ts AS DATE) AS report_dt, NULLIF(n_name, 'NATION_0') AS province_state,
           r_name AS country_region, DATE_TRUNC('second', MAX(ts)) AS last_update,
           CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
           COUNT(*) AS confirmed,
           COUNT(*) FILTER (WHERE event_type = 'error') AS deaths,
           COUNT(*) FILTER (WHERE event_type = 'purchase') AS recovered,
           COUNT(*) - COUNT(*) FILTER (WHERE event_type = 'error') AS active
    FROM events
    JOIN customer ON user_id = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY CAST(ts AS DATE), n_name, r_name, n_nationkey, n_regionkey
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"

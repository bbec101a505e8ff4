"""Windows along a series and maxima over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from casetrends.operators import (
    daily_delta,
    latest_rows,
    ranged_series_metrics,
    series_metrics,
    trailing_avg,
    with_global_max,
)
from casetrends.sources import scratch_path
from querybook.registry import query
from querybook.views import (
    SQL_NATION_DAYS,
    SQL_ORDER_DAYS,
    SQL_PLACES,
    global_long,
    order_dates,
    sql_global_long,
    sql_round,
    sql_us_long,
    table,
    us_long,
    with_ctes,
)

COUNTY = with_ctes(SQL_ORDER_DAYS, SQL_PLACES, sql_us_long("confirmed"))
SERIES = ["combined_key"]


def counties(spark, sf):
    return us_long(spark, sf, "confirmed").select("dt", "combined_key", "total_confirmed")


SQL_DELTA = "total_confirmed - LAG(total_confirmed) OVER (PARTITION BY combined_key ORDER BY dt)"


@query(
    "W1_daily_delta",
    COUNTY + f"SELECT dt, combined_key, total_confirmed, {SQL_DELTA} AS daily_new_confirmed FROM us_confirmed",
)
def delta(spark, sf):
    return daily_delta(counties(spark, sf), SERIES, "confirmed")


@query(
    "W1_daily_delta_latest_rows",
    """
WITH latest AS (
    SELECT user_id, CAST(ts AS DATE) AS dt, event_id, event_type,
           CAST(FLOOR(value * 100) AS BIGINT) AS total_confirmed
    FROM events
    QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1
)
SELECT *, total_confirmed - LAG(total_confirmed) OVER (PARTITION BY user_id ORDER BY dt)
              AS daily_new_confirmed
FROM latest""",
)
def latest_delta(spark, sf):
    """Every event is a total of its user; a day's last one stands, whole."""
    totals = table(spark, sf, "events").select(
        "user_id",
        F.col("ts").cast("date").alias("dt"),
        "ts",
        "event_id",
        "event_type",
        F.floor(F.col("value") * 100).cast("bigint").alias("total_confirmed"),
    )
    latest = latest_rows(totals, ["user_id"], ["ts", "event_id"])
    return daily_delta(latest.drop("ts"), ["user_id"], "confirmed")


@query(
    "W2_first_row_fallback",
    COUNTY
    + f"""SELECT dt, combined_key, total_confirmed,
                 COALESCE({SQL_DELTA}, total_confirmed) AS daily_new_confirmed FROM us_confirmed""",
)
def fallback(spark, sf):
    return daily_delta(counties(spark, sf), SERIES, "confirmed", fallback=True)


def _sql_average(rows: int) -> str:
    frame = f"OVER (PARTITION BY combined_key ORDER BY dt ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return (
        COUNTY
        + f""", fresh AS (
                SELECT dt, combined_key, COALESCE({SQL_DELTA}, total_confirmed)
                           AS daily_new_confirmed
                FROM us_confirmed)
            SELECT dt, combined_key, daily_new_confirmed,
                   {sql_round(f"AVG(daily_new_confirmed) {frame}", 1)}
                       AS daily_new_confirmed_{rows}d_ma
            FROM fresh"""
    )


def _average(spark, sf, rows):
    fresh = daily_delta(counties(spark, sf), SERIES, "confirmed", fallback=True)
    return trailing_avg(fresh.drop("total_confirmed"), SERIES, "confirmed", rows=rows)


@query("W3_trailing_avg_7", _sql_average(7))
def average_7(spark, sf):
    return _average(spark, sf, 7)


@query("W4_trailing_avg_28", _sql_average(28))
def average_28(spark, sf):
    return _average(spark, sf, 28)


@query(
    "W4_trailing_avg_28_ranged",
    f"""WITH fresh AS (
            SELECT o_orderstatus, o_orderdate, o_orderkey,
                   CAST(FLOOR(o_totalprice) AS BIGINT) AS total_price,
                   COALESCE(CAST(FLOOR(o_totalprice) AS BIGINT)
                            - LAG(CAST(FLOOR(o_totalprice) AS BIGINT)) OVER w,
                            CAST(FLOOR(o_totalprice) AS BIGINT)) AS daily_new_price
            FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey))
        SELECT *, {", ".join(sql_round(f"""AVG(daily_new_price) OVER (
                       PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey
                       ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)""", 1)
                  + f" AS daily_new_price_{n}d_ma" for n in (7, 28))}
        FROM fresh""",
)
def average_28_ranged(spark, sf):
    """Three series of all orders: days repeat, and two series hold nearly all rows."""
    orders = table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderdate", "o_orderkey",
        F.floor("o_totalprice").cast("bigint").alias("total_price"),
    )
    return ranged_series_metrics(
        orders, ["o_orderstatus"], ["price"], scratch_path(spark, "ranges"),
        order=("o_orderdate", "o_orderkey"),
    )


@query(
    "W3_trailing_avg_7_calendar",
    with_ctes(SQL_NATION_DAYS, sql_global_long("deaths"))
    + f""", days AS (
             SELECT province_state, country_region,
                    CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dt
             FROM (SELECT province_state, country_region, MIN(dt) AS lo, MAX(dt) AS hi
                   FROM global_deaths GROUP BY ALL)),
         dense AS (
             SELECT d.*, LAST_VALUE(total_deaths IGNORE NULLS) OVER (
                        PARTITION BY d.province_state, d.country_region ORDER BY d.dt) AS total_deaths
             FROM days d LEFT JOIN global_deaths g
               ON d.dt = g.dt AND d.country_region = g.country_region
              AND d.province_state IS NOT DISTINCT FROM g.province_state),
         fresh AS (
             SELECT *, COALESCE(total_deaths - LAG(total_deaths) OVER w, total_deaths) AS daily_new_deaths
             FROM dense WINDOW w AS (PARTITION BY province_state, country_region ORDER BY dt))
         SELECT *, {sql_round("""AVG(daily_new_deaths) OVER (
                        PARTITION BY province_state, country_region ORDER BY dt
                        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""", 1)} AS daily_new_deaths_7d_ma
         FROM fresh""",
)
def average_7_calendar(spark, sf):
    """Averages over seven days, not seven rows: days without a report carry the last total on."""
    rows = global_long(spark, sf, "deaths")
    rows = rows.select("dt", "province_state", "country_region", "total_deaths")
    keys = ["province_state", "country_region"]
    return series_metrics(rows, keys, ["deaths"], rows=(7,), calendar=True, fill="ffill")


SQL_W5 = """FROM global_deaths
         WINDOW w AS (PARTITION BY province_state, country_region ORDER BY dt)"""


@query(
    "W5_composite_null_key_window",
    with_ctes(SQL_NATION_DAYS, sql_global_long("deaths"))
    + f""", fresh AS (
             SELECT dt, province_state, country_region, total_deaths,
                    COALESCE(total_deaths - LAG(total_deaths) OVER w, total_deaths)
                        AS daily_new_deaths {SQL_W5})
         SELECT *, {sql_round('''AVG(daily_new_deaths) OVER (
                        PARTITION BY province_state, country_region ORDER BY dt
                        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)''', 1)} AS daily_new_deaths_7d_ma
         FROM fresh""",
)
def composite_null_key(spark, sf):
    rows = global_long(spark, sf, "deaths")
    rows = rows.select("dt", "province_state", "country_region", "total_deaths")
    return series_metrics(rows, ["province_state", "country_region"], ["deaths"], rows=(7,))


SQL_G2 = COUNTY + """SELECT dt, combined_key, total_confirmed, MAX(dt) OVER () AS last_updated_dt
                     FROM us_confirmed"""


@query("G2_global_max", SQL_G2)
def global_max(spark, sf):
    return with_global_max(counties(spark, sf), over=order_dates(spark, sf))


@query(
    "W6_whole_table_window",
    with_ctes(SQL_NATION_DAYS, sql_global_long("recovered"))
    + """SELECT dt, province_state, country_region, total_recovered, last_updated_dt FROM (
             SELECT *, MAX(dt) OVER () AS last_updated_dt FROM global_recovered)
         WHERE dt = last_updated_dt""",
)
def whole_table_window(spark, sf):
    rows = global_long(spark, sf, "recovered").drop("latitude", "longitude")
    # One maximum serves both: the subquery of the column is reused by the filter on it.
    dated = with_global_max(rows)
    return dated.filter(F.col("dt") == F.col("last_updated_dt"))

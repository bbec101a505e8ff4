"""Wide to long."""

from __future__ import annotations

from pyspark.sql import functions as F

from casetrends.operators import dated_structs, unnest, unpivot_wide
from casetrends.schemas import US_PLACE
from querybook.registry import query
from querybook.views import (
    SQL_AXIS,
    SQL_PLACES,
    day_columns,
    sql_us_long_of_wide,
    us_wide,
    with_ctes,
)


@query(
    "R1_unpivot_wide",
    with_ctes(SQL_PLACES, SQL_AXIS, sql_us_long_of_wide("confirmed"))
    + f"SELECT dt, {', '.join(US_PLACE)}, total_confirmed FROM us_confirmed_melted",
)
def unpivot(spark, sf):
    return unpivot_wide(us_wide(spark, sf, "confirmed"), list(US_PLACE), "confirmed")


@query(
    "R2_array_of_struct",
    with_ctes(SQL_PLACES, SQL_AXIS, sql_us_long_of_wide("deaths"))
    + """SELECT combined_key, CAST(dt - (SELECT MIN(dt) FROM axis) AS INTEGER) AS position, dt,
                total_deaths, CAST((SELECT COUNT(*) FROM axis) AS INTEGER) AS days
         FROM us_deaths_melted""",
)
def array_of_struct(spark, sf):
    """Every struct of every array, with its position and the array's length."""
    dated = dated_structs(us_wide(spark, sf, "deaths"), day_columns(spark, sf), "deaths")
    structs = dated.select(
        "combined_key", F.size("arr").alias("days"), F.posexplode("arr").alias("position", "x")
    )
    return structs.select("combined_key", "position", "x.dt", "x.total_deaths", "days")


@query(
    "R3_unnest",
    with_ctes(SQL_PLACES, SQL_AXIS, sql_us_long_of_wide("deaths"))
    + "SELECT combined_key, population, dt, total_deaths FROM us_deaths_melted",
)
def unnest_array(spark, sf):
    dated = dated_structs(us_wide(spark, sf, "deaths"), day_columns(spark, sf), "deaths")
    return unnest(dated.select("combined_key", "population", "arr"), "arr")

"""Projections, filters, joins, unions, roll-ups and previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from casetrends.functions import date_header
from casetrends.functions.dates import column_day
from casetrends.functions.rates import plausible_rate
from casetrends.operators import (
    UnknownColumnsError,
    column_slice,
    enrich,
    full_align,
    insert_column_at,
    latest_snapshot,
    null_columns,
    null_tolerant_eq,
    preview,
    profile,
    reject_unknown_columns,
    rollup_region,
    salted_full_join,
    stack_align,
    standardize_report,
    union_drifted,
    union_sources,
    unpivot_wide,
)
from casetrends.schemas import US_DAILY
from querybook.registry import query
from querybook.views import (
    SQL_AXIS,
    SQL_NATION_DAYS,
    SQL_ORDER_DAYS,
    SQL_PLACES,
    SQL_REPORTS,
    US_IDS,
    day_columns,
    global_long,
    order_dates,
    places,
    reports,
    sql_global_long,
    sql_us_long,
    sql_us_long_of_wide,
    table,
    us_long,
    us_reports,
    us_wide,
    with_ctes,
)

# --- projections ------------------------------------------------------------------------------


@query(
    "P1_positional_rename",
    """SELECT c_custkey AS place_id, c_name AS county, c_nationkey AS state_id,
              c_acctbal AS balance, c_mktsegment AS segment FROM customer""",
)
def positional_rename(spark, sf):
    return table(spark, sf, "customer").toDF("place_id", "county", "state_id", "balance", "segment")


def _sql_melted(metric: str) -> str:
    return with_ctes(SQL_PLACES, SQL_AXIS, sql_us_long_of_wide(metric))


# Wide results are melted: a table has as many columns as its data have days, SQL text has not.


@query(
    "P2_date_header_normalize",
    _sql_melted("confirmed") + "SELECT combined_key, dt, total_confirmed FROM us_confirmed_melted",
)
def date_header_normalize(spark, sf):
    columns = day_columns(spark, sf)
    headers = [f"{d.month}/{d.day}/{d:%y}" for d in map(column_day, columns)]
    published = us_wide(spark, sf, "confirmed").select("combined_key", *columns)
    published = published.toDF("combined_key", *headers)
    named = published.toDF("combined_key", *[date_header(h) for h in published.columns[1:]])
    return unpivot_wide(named, ["combined_key"], "confirmed")


def _spelled(spark, sf):
    """US reports as text under source spellings, two of them for one column."""
    rows = us_reports(spark, sf)
    return rows.select(
        "report_dt",
        F.col("province_state").alias("Province_State"),
        F.col("country_region").alias("Country_Region"),
        F.col("confirmed").cast("double").cast("string").alias("Confirmed"),
        F.col("deaths").cast("string").alias("Deaths"),
        F.when(F.col("deaths") > 0, F.col("active")).cast("string").alias("Total_Test_Results"),
        F.col("recovered").cast("string").alias("People_Tested"),
        F.col("latitude").cast("string").alias("Lat"),
    )


@query(
    "P3_standardize_report",
    with_ctes(SQL_NATION_DAYS, SQL_REPORTS)
    + """SELECT report_dt, CAST(NULL AS BIGINT) AS "UID", CAST(NULL AS BIGINT) AS "FIPS",
                CAST(NULL AS VARCHAR) AS iso3, province_state, country_region, latitude,
                CAST(NULL AS DOUBLE) AS longitude, confirmed, deaths,
                CAST(NULL AS BIGINT) AS recovered, CAST(NULL AS BIGINT) AS active,
                CAST(NULL AS DOUBLE) AS incident_rate, CAST(NULL AS DOUBLE) AS case_fatality_ratio,
                CASE WHEN deaths > 0 THEN active ELSE recovered END AS total_test_results,
                CAST(NULL AS DOUBLE) AS testing_rate, CAST(NULL AS BIGINT) AS people_hospitalized,
                CAST(NULL AS DOUBLE) AS hospitalization_rate,
                CAST(NULL AS TIMESTAMP) AS last_update
         FROM us_reports""",
)
def standardize(spark, sf):
    rows = standardize_report(_spelled(spark, sf), US_DAILY, keep=("report_dt",))
    return rows.withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))


@query(
    "P4_reject_unknown_columns",
    with_ctes(SQL_NATION_DAYS, SQL_REPORTS)
    + """SELECT report_dt, COUNT(*) AS accepted_rows, 'Surprise' AS rejected_column
         FROM us_reports GROUP BY report_dt""",
)
def reject_unknown(spark, sf):
    known = _spelled(spark, sf)
    drifted = known.withColumn("Surprise", F.lit("x"))
    headers = {
        "known.csv": [c for c in known.columns if c != "report_dt"],
        "drifted.csv": [c for c in drifted.columns if c != "report_dt"],
    }
    refused = []
    for name, header in headers.items():
        try:
            reject_unknown_columns({name: header}, US_DAILY)
        except UnknownColumnsError as error:
            refused.append(str(error))
    if len(refused) != 1 or "drifted.csv" not in refused[0] or "Surprise" not in refused[0]:
        raise AssertionError(refused)
    accepted = standardize_report(known, US_DAILY, keep=("report_dt",))
    return accepted.groupBy("report_dt").agg(
        F.count("*").alias("accepted_rows"), F.lit("Surprise").alias("rejected_column")
    )


@query(
    "P5_select_alias",
    with_ctes(SQL_NATION_DAYS, SQL_REPORTS)
    + "SELECT report_dt AS dt, confirmed AS total_confirmed, deaths AS total_deaths FROM us_reports",
)
def select_alias(spark, sf):
    return us_reports(spark, sf).select(
        F.col("report_dt").alias("dt"),
        F.col("confirmed").alias("total_confirmed"),
        F.col("deaths").alias("total_deaths"),
    )


@query(
    "P6_select_except",
    "SELECT * EXCLUDE (o_orderpriority, o_totalprice) FROM orders",
)
def select_except(spark, sf):
    return table(spark, sf, "orders").drop("o_orderpriority", "o_totalprice")


@query(
    "P7_replace_column",
    _sql_melted("confirmed")
    + """SELECT combined_key, dt, CASE WHEN dt = (SELECT MIN(dt) FROM axis) + 1
                                      THEN COALESCE(total_confirmed, 0) ELSE total_confirmed END
                AS total_confirmed FROM us_confirmed_melted""",
)
def replace_column(spark, sf):
    columns = day_columns(spark, sf)
    wide = us_wide(spark, sf, "confirmed").select("combined_key", *columns)
    replaced = wide.withColumns({c: F.coalesce(c, F.lit(0)) for c in columns[1:2]})
    return unpivot_wide(replaced, ["combined_key"], "confirmed")


@query(
    "P8_latest_snapshot",
    with_ctes(SQL_ORDER_DAYS, SQL_PLACES, sql_us_long("confirmed"))
    + "SELECT * FROM us_confirmed WHERE dt = (SELECT MAX(dt) FROM us_confirmed)",
)
def snapshot(spark, sf):
    return latest_snapshot(us_long(spark, sf, "confirmed"), over=order_dates(spark, sf))


@query(
    "P9_neq_filter",
    with_ctes(SQL_NATION_DAYS, SQL_REPORTS)
    + """SELECT report_dt, province_state, country_region, confirmed FROM reports
         WHERE province_state <> 'Recovered' AND country_region <> 'EUROPE'""",
)
def neq_filter(spark, sf):
    rows = reports(spark, sf).select("report_dt", "province_state", "country_region", "confirmed")
    return rows.filter(
        (F.col("province_state") != "Recovered") & (F.col("country_region") != "EUROPE")
    )


@query(
    "P10_column_slice",
    _sql_melted("deaths")
    + f"""SELECT {", ".join(f'"{c}"' for c in US_IDS)}, population, dt, total_deaths
          FROM us_deaths_melted WHERE dt < (SELECT MIN(dt) FROM axis) + 3""",
)
def slice_columns(spark, sf):
    part = column_slice(us_wide(spark, sf, "deaths"), 0, len(US_IDS) + 1 + 3)
    return unpivot_wide(part, [*US_IDS, "population"], "deaths")


@query(
    "P11_null_literal_columns",
    """SELECT s_suppkey, s_name, CAST(NULL AS BIGINT) AS total_test_results,
              CAST(NULL AS DOUBLE) AS testing_rate FROM supplier""",
)
def null_literal_columns(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return null_columns(rows, {"total_test_results": "bigint", "testing_rate": "double"})


@query(
    "P12_insert_column_at",
    _sql_melted("confirmed")
    + """SELECT w."UID", w.combined_key, p.population, dt, total_confirmed
         FROM us_confirmed_melted w JOIN places p ON w.combined_key = p.combined_key""",
)
def insert_population(spark, sf):
    wide = us_wide(spark, sf, "confirmed")
    people = places(spark, sf).select("combined_key", F.col("population").alias("people"))
    located = wide.join(people, "combined_key").select(*wide.columns, "people")
    placed = insert_column_at(located, 11, "population", F.col("people"))
    assert placed.columns[10:12] == ["combined_key", "population"]
    return unpivot_wide(placed, ["UID", "combined_key", "population"], "confirmed")


@query(
    "P13_profile",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, COUNT(*) AS rows, "
        f"COUNT({c}) AS present FROM orders"
        for i, (c, t) in enumerate(
            [
                ("o_orderkey", "bigint"),
                ("o_custkey", "bigint"),
                ("o_orderstatus", "string"),
                ("o_totalprice", "double"),
                ("o_orderdate", "timestamp_ntz"),
                ("o_orderpriority", "string"),
            ]
        )
    ),
)
def profile_orders(spark, sf):
    return profile(table(spark, sf, "orders"))


@query(
    "P14_sentinel_to_null",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN NULL
                               ELSE o_totalprice / CAST(100000 AS DOUBLE) END AS rate FROM orders""",
)
def sentinel_to_null(spark, sf):
    rate = plausible_rate(F.col("o_totalprice")) / 100000
    return table(spark, sf, "orders").select("o_orderkey", rate.alias("rate"))


# --- joins --------------------------------------------------------------------------------------

US_DESCRIBE = ["county", "province_state", "country_region", "latitude", "longitude"]


def _coalesced(names, *sides):
    return ", ".join(f"COALESCE({', '.join(f'{s}.{n}' for s in sides)}) AS {n}" for n in names)


SQL_J1 = with_ctes(
    SQL_ORDER_DAYS, SQL_PLACES, sql_us_long("deaths"), sql_us_long("recovered")
) + f"""SELECT {_coalesced(["dt", "combined_key", *US_DESCRIBE], "a", "b")},
               COALESCE(total_deaths, 0) AS total_deaths,
               COALESCE(total_recovered, 0) AS total_recovered
        FROM us_deaths a FULL JOIN us_recovered b
          ON a.dt = b.dt AND a.combined_key = b.combined_key"""


@query("J1_full_align_2", SQL_J1)
def full_align_2(spark, sf):
    frames = [us_long(spark, sf, m) for m in ("deaths", "recovered")]
    return full_align(frames, on=["dt", "combined_key"], describe=US_DESCRIBE)


@query("J1_full_align_2_stacked", SQL_J1)
def full_align_2_stacked(spark, sf):
    frames = [us_long(spark, sf, m) for m in ("deaths", "recovered")]
    return stack_align(frames, on=["dt", "combined_key"], describe=US_DESCRIBE)


@query("J1_full_align_2_salted", SQL_J1)
def full_align_2_salted(spark, sf):
    frames = [us_long(spark, sf, m) for m in ("deaths", "recovered")]
    return full_align(frames, on=["dt", "combined_key"], describe=US_DESCRIBE, salts=16)


@query(
    "J1_full_join_hot_keys",
    """WITH a AS (SELECT o_orderstatus AS status, o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
            b AS (SELECT o_orderstatus AS kind, o_custkey, COUNT(*) AS n FROM orders
                  WHERE o_orderstatus <> 'F' AND o_custkey % 97 = 0 GROUP BY ALL)
       SELECT status, o_orderkey, kind, o_custkey, n FROM a FULL JOIN b ON status = kind""",
)
def full_join_hot_keys(spark, sf):
    """Two of three keys hold nearly all rows: one on both sides, one on the left, one on the right."""
    orders = table(spark, sf, "orders")
    a = orders.filter(F.col("o_orderstatus") != "P").select(F.col("o_orderstatus").alias("status"), "o_orderkey")
    b = (
        orders.filter((F.col("o_orderstatus") != "F") & (F.col("o_custkey") % 97 == 0))
        .groupBy(F.col("o_orderstatus").alias("kind"), "o_custkey")
        .agg(F.count("*").alias("n"))
    )
    return salted_full_join(a, b, [F.col("status")], [F.col("kind")], salts=16)


WORLD_KEYS = ["dt", "province_state", "country_region"]
WORLD_METRICS = ("deaths", "recovered", "active")


def _sql_j2(coalesce_keys: bool) -> str:
    def key(name: str) -> str:
        return f"COALESCE(a.{name}, b.{name})" if coalesce_keys else f"a.{name}"

    return with_ctes(
        SQL_NATION_DAYS, *[sql_global_long(m) for m in WORLD_METRICS]
    ) + f"""SELECT {_coalesced([*WORLD_KEYS, "latitude", "longitude"], "a", "b", "c")},
               {", ".join(f"COALESCE(total_{m}, 0) AS total_{m}" for m in WORLD_METRICS)}
        FROM global_deaths a
        FULL JOIN global_recovered b
          ON a.dt = b.dt AND COALESCE(a.province_state, '') = COALESCE(b.province_state, '')
         AND a.country_region = b.country_region
        FULL JOIN global_active c
          ON {key("dt")} = c.dt
         AND COALESCE({key("province_state")}, '') = COALESCE(c.province_state, '')
         AND {key("country_region")} = c.country_region"""


def _full_align_3(spark, sf, coalesce_keys, salts=None):
    return full_align(
        [global_long(spark, sf, m) for m in WORLD_METRICS],
        on=WORLD_KEYS,
        describe=["latitude", "longitude"],
        null_tolerant=["province_state"],
        coalesce_keys=coalesce_keys,
        salts=salts,
    )


@query("J2_full_align_3_salted", _sql_j2(coalesce_keys=True))
def full_align_3_salted(spark, sf):
    return _full_align_3(spark, sf, coalesce_keys=True, salts=16)


@query("J2_full_align_3", _sql_j2(coalesce_keys=False))
def full_align_3(spark, sf):
    return _full_align_3(spark, sf, coalesce_keys=False)


@query("J2_full_align_3_one_row_per_key", _sql_j2(coalesce_keys=True))
def full_align_3_one_row(spark, sf):
    return _full_align_3(spark, sf, coalesce_keys=True)


@query(
    "J3_left_enrich",
    with_ctes(SQL_ORDER_DAYS, SQL_PLACES, SQL_AXIS, sql_us_long("confirmed"), sql_us_long_of_wide("deaths"))
    + """SELECT a.dt, a.combined_key, a.total_confirmed, b.population
         FROM us_confirmed a
         LEFT JOIN (SELECT DISTINCT combined_key, population FROM us_deaths_melted) b
           ON a.combined_key = b.combined_key""",
)
def left_enrich(spark, sf):
    series = us_long(spark, sf, "confirmed").select("dt", "combined_key", "total_confirmed")
    return enrich(series, us_wide(spark, sf, "deaths"), ["combined_key"], ["population"])


@query(
    "J4_null_tolerant_equi",
    with_ctes(SQL_NATION_DAYS, sql_global_long("deaths"), sql_global_long("recovered"))
    + """, blank AS (
             SELECT dt, COALESCE(province_state, '') AS province_state, country_region,
                    total_recovered
             FROM global_recovered)
         SELECT a.dt, a.province_state, b.province_state AS matched_state, a.country_region,
                total_deaths, total_recovered
         FROM global_deaths a JOIN blank b
           ON a.dt = b.dt AND COALESCE(a.province_state, '') = COALESCE(b.province_state, '')
          AND a.country_region = b.country_region""",
)
def null_tolerant_join(spark, sf):
    left = global_long(spark, sf, "deaths").alias("a")
    blank = F.coalesce("province_state", F.lit("")).alias("province_state")
    right = (
        global_long(spark, sf, "recovered")
        .select("dt", blank, "country_region", "total_recovered")
        .alias("b")
    )
    return left.join(
        right,
        (F.col("a.dt") == F.col("b.dt"))
        & null_tolerant_eq(F.col("a.province_state"), F.col("b.province_state"))
        & (F.col("a.country_region") == F.col("b.country_region")),
    ).select(
        "a.dt",
        "a.province_state",
        F.col("b.province_state").alias("matched_state"),
        "a.country_region",
        "total_deaths",
        "total_recovered",
    )


# --- roll-up, unions, preview -------------------------------------------------------------------


@query(
    "G1_rollup_region",
    with_ctes(SQL_ORDER_DAYS, SQL_PLACES, sql_us_long("confirmed"))
    + """SELECT a.dt, a.province_state, a.country_region,
                CAST(SUM(population) AS BIGINT) AS population,
                CAST(SUM(total_confirmed) AS BIGINT) AS total_confirmed
         FROM us_confirmed a JOIN places p ON a.combined_key = p.combined_key
         GROUP BY a.dt, a.province_state, a.country_region""",
)
def rollup(spark, sf):
    people = places(spark, sf).select("combined_key", "population")
    counties = us_long(spark, sf, "confirmed").join(people, "combined_key")
    return rollup_region(
        counties, ["dt", "province_state", "country_region"], ["population", "total_confirmed"]
    )


@query(
    "U1_union_all_sources",
    with_ctes(SQL_NATION_DAYS, SQL_REPORTS)
    + """SELECT report_dt AS dt, province_state, country_region, confirmed AS total_confirmed,
                total_test_results, testing_rate
         FROM us_reports WHERE province_state <> 'Recovered'
         UNION ALL
         SELECT report_dt AS dt, province_state, country_region, confirmed AS total_confirmed,
                NULL AS total_test_results, NULL AS testing_rate
         FROM reports WHERE country_region <> 'US'""",
)
def union_all(spark, sf):
    shared = [
        F.col("report_dt").alias("dt"),
        "province_state",
        "country_region",
        F.col("confirmed").alias("total_confirmed"),
    ]
    states = us_reports(spark, sf).filter(F.col("province_state") != "Recovered")
    world = reports(spark, sf).filter(F.col("country_region") != "US")
    return union_sources(
        states.select(*shared, "total_test_results", "testing_rate"),
        null_columns(
            world.select(*shared), {"total_test_results": "bigint", "testing_rate": "double"}
        ),
    )


@query(
    "U2_union_by_header",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance,
              c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS price FROM customer
       UNION ALL
       SELECT s_suppkey, s_name, s_acctbal, NULL, NULL FROM supplier
       UNION ALL
       SELECT p_partkey, p_name, NULL, NULL, p_retailprice FROM part""",
)
def union_by_header(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("key"),
        F.col("s_name").alias("name"),
    )
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )
    return union_drifted(customer, supplier, part)


@query("L1_preview", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def preview_orders(spark, sf):
    return preview(table(spark, sf, "orders"), order_by=[F.desc("o_totalprice"), F.asc("o_orderkey")])

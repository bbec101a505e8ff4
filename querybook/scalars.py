"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.functions import (
    compact_date,
    date_span,
    has_suffix,
    implied_population,
    local_stamp,
    parse_dated_name,
    parse_timestamp,
    per_person,
    report_file_name,
    round_to_long,
    safe_ratio,
    strip_suffix,
    strip_utc_offset,
    typed,
    whole_to_long,
    yesterday,
)
from querybook.registry import query
from querybook.views import SQL_NATION_DAYS, SQL_REPORTS, reports, sql_round, table, with_ctes


def day(name: str):
    return F.col(name).cast("date")


@query(
    "F1_parse_date",
    """SELECT o_orderkey, STRPTIME(STRFTIME(o_orderdate, 'dt_%Y%m%d'), 'dt_%Y%m%d')::DATE AS dt
       FROM orders""",
)
def parse_date(spark, sf):
    name = F.concat(F.lit("dt_"), compact_date(day("o_orderdate")))
    return table(spark, sf, "orders").select("o_orderkey", parse_dated_name(name).alias("dt"))


@query(
    "F2_coalesce",
    """SELECT n_nationkey, COALESCE(NULLIF(n_name, 'NATION_0'), r_name, 'none') AS place
       FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'AFRICA'""",
)
def coalesce(spark, sf):
    region = table(spark, sf, "region").filter(F.col("r_name") != "AFRICA")
    joined = table(spark, sf, "nation").join(
        region, F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    name = F.when(F.col("n_name") != "NATION_0", F.col("n_name"))
    return joined.select("n_nationkey", F.coalesce(name, "r_name", F.lit("none")).alias("place"))


@query(
    "F3_ifnull",
    """SELECT c_custkey, IFNULL(fulfilled, 0) AS fulfilled FROM customer
       LEFT JOIN (SELECT o_custkey, COUNT(*) AS fulfilled FROM orders
                  WHERE o_orderstatus = 'F' GROUP BY o_custkey)
         ON c_custkey = o_custkey""",
)
def ifnull(spark, sf):
    fulfilled = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("fulfilled"))
    )
    joined = table(spark, sf, "customer").join(
        fulfilled, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    return joined.select("c_custkey", F.ifnull("fulfilled", F.lit(0)).alias("fulfilled"))


@query(
    "F4_if",
    """SELECT p_partkey, CASE WHEN NULLIF(p_size, 7) > 25 THEN 'large' ELSE 'other' END AS size_class
       FROM part""",
)
def if_else(spark, sf):
    size = F.nullif("p_size", F.lit(7))
    return table(spark, sf, "part").select(
        "p_partkey", F.when(size > 25, "large").otherwise("other").alias("size_class")
    )


@query(
    "F5_round",
    f"""SELECT o_orderkey, {sql_round("o_totalprice / 7", 1)} AS price_1,
               {sql_round("-o_totalprice / 8", 4)} AS price_4 FROM orders""",
)
def rounded(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey", F.round(price / 7, 1).alias("price_1"), F.round(-price / 8, 4).alias("price_4")
    )


@query(
    "F6_safe_ratio",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
               CASE WHEN l_tax = 0 THEN NULL ELSE {sql_round("l_discount / l_tax", 4)} END AS ratio
        FROM lineitem""",
)
def ratio(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        safe_ratio(F.col("l_discount"), F.col("l_tax")).alias("ratio"),
    )


@query(
    "F7_cast_float_to_int64",
    "SELECT p_partkey, CAST(ROUND(p_retailprice * CAST(2.5 AS DOUBLE)) AS BIGINT) AS whole FROM part",
)
def float_to_long(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", round_to_long(F.col("p_retailprice") * F.lit(2.5)).alias("whole")
    )


@query(
    "F8_local_stamp",
    "SELECT event_id, ts - INTERVAL 8 HOUR AS last_updated_ts FROM events",
)
def stamp(spark, sf):
    # All events are in January, when the publishing zone is eight hours behind UTC.
    return table(spark, sf, "events").select(
        "event_id",
        local_stamp(F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("last_updated_ts"),
    )


@query(
    "F9_regexp_replace",
    """SELECT event_id, STRFTIME(ts, '%Y-%m-%d %H:%M:%S') AS stamp, event_type || '-7' AS kept
       FROM events""",
)
def regexp_replace(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        strip_utc_offset(F.concat(text, F.lit("-07"))).alias("stamp"),
        strip_utc_offset(F.concat("event_type", F.lit("-7"))).alias("kept"),
    )


@query("F10_date_of_timestamp", "SELECT event_id, CAST(ts AS DATE) AS dt FROM events")
def date_of_timestamp(spark, sf):
    return table(spark, sf, "events").select("event_id", F.to_date("ts").alias("dt"))


@query(
    "F11_rate_rescale",
    with_ctes(SQL_NATION_DAYS, SQL_REPORTS)
    + f"""SELECT report_dt, province_state, country_region,
                 CASE WHEN incident_rate > 100000 THEN NULL
                      ELSE incident_rate / 100000 END AS incident_rate,
                 {sql_round("CASE WHEN testing_rate > 100000 THEN NULL ELSE testing_rate / 100000 END", 4)}
                     AS testing_rate
          FROM reports""",
)
def rate_rescale(spark, sf):
    return reports(spark, sf).select(
        "report_dt",
        "province_state",
        "country_region",
        per_person(F.col("incident_rate")).alias("incident_rate"),
        per_person(F.col("testing_rate"), 4).alias("testing_rate"),
    )


@query(
    "F12_implied_population",
    with_ctes(SQL_NATION_DAYS, SQL_REPORTS)
    + """SELECT report_dt, province_state, country_region,
                CAST(ROUND(CASE WHEN rate = 0 THEN NULL ELSE confirmed / rate END) AS BIGINT)
                    AS population
         FROM (SELECT *, CASE WHEN incident_rate > 100000 THEN NULL
                              ELSE incident_rate / 100000 END AS rate FROM reports)""",
)
def population(spark, sf):
    rate = per_person(F.col("incident_rate"))
    return reports(spark, sf).select(
        "report_dt",
        "province_state",
        "country_region",
        implied_population(F.col("confirmed"), rate).alias("population"),
    )


@query(
    "F13_typed_text",
    """SELECT event_id, TRY_CAST(REPLACE(props, '{"k": ', '') AS BIGINT) AS junk,
              CAST(REGEXP_EXTRACT(props, '[0-9]+') AS BIGINT) AS k, value,
              DATE_TRUNC('minute', ts) AS seen FROM events""",
)
def typed_text(spark, sf):
    minutes = table(spark, sf, "events").withColumn("minute", F.date_format("ts", "M/d/yyyy H:mm"))
    return minutes.select(
        "event_id",
        typed("replace(props, '{\"k\": ', '')", T.LongType(), "permissive").alias("junk"),
        typed("regexp_extract(props, '[0-9]+', 0)", T.LongType()).alias("k"),
        typed("CAST(value AS string)", T.DoubleType()).alias("value"),
        parse_timestamp("minute").cast("timestamp_ntz").alias("seen"),
    )


@query(
    "F14_whole_to_long",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
              CAST(l_quantity AS BIGINT) AS quantity,
              CASE WHEN l_extendedprice = FLOOR(l_extendedprice)
                   THEN CAST(l_extendedprice AS BIGINT) END AS whole_price FROM lineitem""",
)
def whole(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        whole_to_long("l_quantity").alias("quantity"),
        whole_to_long("l_extendedprice").alias("whole_price"),
    )


@query(
    "F15_date_texts",
    """SELECT o_orderkey, STRFTIME(o_orderdate, '%m-%d-%Y') AS file_stem,
              STRFTIME(o_orderdate, '%Y%m%d') AS partition, CAST(o_orderdate AS DATE) AS dt
       FROM orders""",
)
def date_texts(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        report_file_name(day("o_orderdate")).alias("file_stem"),
        compact_date(day("o_orderdate")).alias("partition"),
        F.to_date(text, "yyyy-MM-dd").alias("dt"),
    )


@query(
    "F16_date_span",
    """SELECT user_id, event_type, CAST(UNNEST(GENERATE_SERIES(first_dt, last_dt, INTERVAL 1 DAY)) AS DATE) AS dt
       FROM (SELECT user_id, event_type, MIN(CAST(ts AS DATE)) AS first_dt,
                    MAX(CAST(ts AS DATE)) AS last_dt FROM events GROUP BY user_id, event_type)""",
)
def span(spark, sf):
    ends = (
        table(spark, sf, "events")
        .groupBy("user_id", "event_type")
        .agg(F.min(day("ts")).alias("first_dt"), F.max(day("ts")).alias("last_dt"))
    )
    return ends.select(
        "user_id", "event_type", F.explode(date_span(F.col("first_dt"), F.col("last_dt"))).alias("dt")
    )


@query(
    "F17_yesterday",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS run_day FROM orders",
)
def day_before(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", yesterday(day("o_orderdate")).alias("run_day")
    )


@query(
    "F18_suffix",
    """SELECT page_id, file_name, file_name LIKE '%.csv' AS is_csv,
              REGEXP_REPLACE(file_name, '\\.csv$', '') AS sheet
       FROM (SELECT page_id, url || CASE WHEN LENGTH(html) > 1500 THEN '.csv' ELSE '.csv.txt' END
                    AS file_name FROM pages)""",
)
def suffix(spark, sf):
    ending = F.when(F.length("html") > 1500, ".csv").otherwise(".csv.txt")
    named = table(spark, sf, "pages").select("page_id", F.concat("url", ending).alias("file_name"))
    name = F.col("file_name")
    return named.select(
        "page_id", name, has_suffix(name).alias("is_csv"), strip_suffix(name).alias("sheet")
    )


@query(
    "F19_arithmetic",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity - l_discount AS diff,
              l_extendedprice / l_quantity AS unit_price, l_returnflag = 'R' AS returned,
              l_linestatus != 'O' AS not_open, l_tax > l_discount AS tax_above FROM lineitem""",
)
def arithmetic(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        (F.col("l_quantity") - F.col("l_discount")).alias("diff"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_linestatus") != "O").alias("not_open"),
        (F.col("l_tax") > F.col("l_discount")).alias("tax_above"),
    )

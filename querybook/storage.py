"""Sources and sinks: every query writes data of the driver's tables and reads it back.

Files and tables go below the shared scratch folder of the session.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.functions import report_file_name
from casetrends.operators import unpivot_wide
from casetrends.plans import ingest_daily_reports
from casetrends.schemas import GLOBAL_DAILY, US_CONFIRMED_IDS
from casetrends.sources import (
    copy_table,
    discover_columns,
    export_table,
    load,
    materialize,
    partition_date,
    read_daily,
    read_wide,
    replace_partitions,
    scratch_path,
    wide_rejects,
    write_partitioned,
    write_wide,
)
from casetrends.streaming import publish_stream, published
from casetrends.streaming.publish import text_schema
from querybook.registry import query
from querybook.views import (
    NEW_HEADER_DAY,
    SQL_AXIS,
    SQL_PLACES,
    SQL_REPORT_TEXTS,
    US_IDS,
    day_columns,
    event_days_range,
    report_texts,
    sql_us_long_of_wide,
    table,
    us_wide,
    with_ctes,
)


def scratch_table(spark: SparkSession, name: str) -> str:
    """A table name in a database of its own whose data lie in the scratch folder."""
    database = f"casetrends_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    return f"{database}.{name}"


# --- files ----------------------------------------------------------------------------------------


@query(
    "S1_wide_csv_scan",
    with_ctes(SQL_PLACES, SQL_AXIS, sql_us_long_of_wide("confirmed"))
    + "SELECT * FROM us_confirmed_melted",
)
def wide_csv_scan(spark, sf):
    """Every cell of the file that was read, one row per place and date column."""
    path = scratch_path(spark, "wide")
    write_wide(us_wide(spark, sf, "confirmed"), path, US_IDS)
    return unpivot_wide(read_wide(spark, path, US_CONFIRMED_IDS), US_IDS, "confirmed")


def _spelled_wide(spark: SparkSession, sf: str) -> str:
    """A wide file in which some counts are written ``12.0``, ``NA`` or with a letter."""
    wide = us_wide(spark, sf, "confirmed")
    columns = day_columns(spark, sf)
    said = [
        F.when(F.col(c) % 7 == 0, F.concat(F.lit("n"), c))
        .when(F.col(c) % 5 == 0, F.concat(c, F.lit(".0")))
        .when(F.col(c) % 3 == 0, "NA").otherwise(F.col(c).cast("string")).alias(c)
        for c in columns
    ]
    path = scratch_path(spark, "spelled")
    write_wide(wide.select(*US_IDS, *said), path, US_IDS)
    return path


@query(
    "S1_wide_permissive",
    with_ctes(SQL_PLACES, SQL_AXIS, sql_us_long_of_wide("confirmed"))
    + """SELECT "UID", dt, CASE WHEN total_confirmed % 7 = 0 THEN NULL
                              WHEN total_confirmed % 5 = 0 THEN total_confirmed
                              WHEN total_confirmed % 3 = 0 THEN NULL ELSE total_confirmed END
                AS total_confirmed FROM us_confirmed_melted""",
)
def wide_permissive(spark, sf):
    rows = read_wide(spark, _spelled_wide(spark, sf), US_CONFIRMED_IDS, mode="permissive")
    return unpivot_wide(rows, ["UID"], "confirmed")


@query(
    "S1_wide_rejects",
    with_ctes(SQL_PLACES, SQL_AXIS, sql_us_long_of_wide("confirmed"))
    + """SELECT strftime(dt, 'dt_%Y%m%d') AS "column", 'n' || total_confirmed AS text,
                COUNT(*) AS rows
         FROM us_confirmed_melted WHERE total_confirmed % 7 = 0 GROUP BY ALL""",
)
def rejected_counts(spark, sf):
    found = wide_rejects(spark, _spelled_wide(spark, sf), US_CONFIRMED_IDS)
    return found.groupBy("column", "text").agg(F.count("*").alias("rows"))


def report_folder(spark: SparkSession, sf: str) -> str:
    """Daily report files of events, with one header before NEW_HEADER_DAY and another since."""
    base = scratch_path(spark, "reports")
    stamped = report_texts(spark, sf).withColumn(
        "report", F.concat(report_file_name(F.col("report_dt")), F.lit(".csv"))
    )
    early = stamped.filter(F.col("report_dt") < F.lit(NEW_HEADER_DAY)).select(
        F.col("province_state").alias("Province/State"),
        F.col("country_region").alias("Country/Region"),
        F.date_format("last_update", "M/d/yyyy H:mm").alias("Last Update"),
        F.col("confirmed").alias("Confirmed"),
        F.col("deaths").alias("Deaths"),
        F.col("recovered").alias("Recovered"),
        "report",
    )
    late = stamped.filter(F.col("report_dt") >= F.lit(NEW_HEADER_DAY)).select(
        F.col("province_state").alias("Province_State"),
        F.col("country_region").alias("Country_Region"),
        F.date_format("last_update", "yyyy-MM-dd HH:mm:ss").alias("Last_Update"),
        F.col("latitude").alias("Lat"),
        F.col("longitude").alias("Long_"),
        F.col("deaths").alias("Deaths"),
        F.col("confirmed").alias("Confirmed"),
        F.col("recovered").cast("double").alias("Recovered"),
        F.col("active").alias("Active"),
        (F.col("confirmed") / F.lit(3.0)).alias("Incidence_Rate"),
        "report",
    )
    for rows in (early, late):
        by_file = rows.hint("rebalance", F.col("report"))
        by_file.write.mode("append").option("header", True).partitionBy("report").csv(base)
    return base


_EARLY = f"report_dt < DATE '{NEW_HEADER_DAY}'"
SQL_STANDARD_REPORTS = f"""
SELECT report_dt, CAST(NULL AS BIGINT) AS "FIPS", CAST(NULL AS VARCHAR) AS county,
       province_state, country_region, CAST(NULL AS VARCHAR) AS combined_key,
       CASE WHEN NOT {_EARLY} THEN latitude END AS latitude,
       CASE WHEN NOT {_EARLY} THEN longitude END AS longitude,
       confirmed, deaths, recovered,
       CASE WHEN NOT {_EARLY} THEN active END AS active,
       CASE WHEN NOT {_EARLY} THEN confirmed / CAST(3 AS DOUBLE) END AS incident_rate,
       CAST(NULL AS DOUBLE) AS case_fatality_ratio,
       CASE WHEN {_EARLY} THEN DATE_TRUNC('minute', last_update) ELSE last_update END AS last_update
FROM report_texts"""


@query("S2_daily_report_scan", with_ctes(SQL_REPORT_TEXTS) + SQL_STANDARD_REPORTS)
def daily_report_scan(spark, sf):
    rows = read_daily(spark, report_folder(spark, sf), GLOBAL_DAILY)
    return rows.withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))


_EARLY_ONLY = ("Province/State", "Country/Region", "Last Update")
_LATE_ONLY = ("Province_State", "Country_Region", "Last_Update", "Lat", "Long_", "Active", "Incidence_Rate")
_ALWAYS = ("Confirmed", "Deaths", "Recovered")


def _sql_headers() -> str:
    groups = [
        (_EARLY_ONLY, f"dt < DATE '{NEW_HEADER_DAY}'"),
        (_LATE_ONLY, f"dt >= DATE '{NEW_HEADER_DAY}'"),
        (_ALWAYS, "TRUE"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", MIN(dt) AS first_dt, MAX(dt) AS last_dt FROM days WHERE {when}"
        for columns, when in groups
        for c in columns
    )


@query(
    "S3_discover_columns",
    f"WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events) {_sql_headers()}",
)
def discover(spark, sf):
    return discover_columns(spark, report_folder(spark, sf), *event_days_range(spark, sf))


# --- tables ---------------------------------------------------------------------------------------

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_name", T.StringType()),
    ]
)


@query("S4_typed_load", "SELECT c_custkey, c_acctbal, c_name FROM customer")
def typed_load(spark, sf):
    customer = table(spark, sf, "customer")
    texts = customer.select(*[F.col(c).cast("string").alias(c) for c in customer.columns])
    name = scratch_table(spark, "customer")
    load(texts, name, CUSTOMER_SCHEMA)
    return spark.table(name)


@query("S5_table_scan", "SELECT o_orderkey, o_totalprice FROM orders")
def table_scan(spark, sf):
    name = scratch_table(spark, "orders")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{sf}/orders.parquet'")
    return spark.table(name).select("o_orderkey", "o_totalprice")


@query(
    "S6_write_disposition",
    """SELECT c_custkey, c_mktsegment, 'append' AS load FROM customer
       UNION ALL SELECT c_custkey, c_mktsegment, 'overwrite' FROM customer WHERE c_acctbal > 5000""",
)
def write_disposition(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    rich = customer.filter(F.col("c_acctbal") > 5000).drop("c_acctbal")
    everyone = customer.drop("c_acctbal")
    name = scratch_table(spark, "customer")
    materialize(everyone.withColumn("load", F.lit("replaced")), name)
    materialize(rich.withColumn("load", F.lit("overwrite")), name)
    return materialize(everyone.withColumn("load", F.lit("append")), name, mode="append")


def event_days(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.col("ts").cast("date").alias("dt"), "event_type")
        .agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))
    )


SQL_EVENT_DAYS = """
event_days AS (
    SELECT CAST(ts AS DATE) AS dt, event_type, COUNT(*) AS n, MAX(event_id) AS last_event
    FROM events GROUP BY ALL
)"""


@query("S7_partitioned_write", with_ctes(SQL_EVENT_DAYS) + "SELECT * FROM event_days")
def partitioned_write(spark, sf):
    return write_partitioned(event_days(spark, sf), scratch_table(spark, "days"))


# The last days of the table are corrected.
CORRECTED = 3


@query(
    "S8_replace_partition",
    with_ctes(SQL_EVENT_DAYS)
    + f"""SELECT dt, event_type, CASE WHEN dt > (SELECT MAX(dt) FROM event_days) - {CORRECTED} THEN -n ELSE n END AS n,
                 last_event FROM event_days""",
)
def replace_partition(spark, sf):
    name = scratch_table(spark, "days")
    days = event_days(spark, sf)
    replace_partitions(days, name, "dt")
    last = event_days_range(spark, sf)[1]
    wanted = [last - timedelta(days=i) for i in range(CORRECTED)]
    corrected = days.filter(F.col("dt").isin(wanted)).withColumn("n", -F.col("n"))
    for _ in range(2):
        replace_partitions(corrected, name, "dt", days=wanted)
    return spark.table(name)


@query(
    "S9_partition_date",
    with_ctes(SQL_EVENT_DAYS)
    + """SELECT dt, event_type, n FROM event_days""",
)
def partition_column(spark, sf):
    name = scratch_table(spark, "days")
    days = event_days(spark, sf).withColumnRenamed("dt", "report_dt")
    return write_partitioned(days, name, "report_dt").select(partition_date(), "event_type", "n")


@query(
    "S10_query_to_table",
    """SELECT o_custkey, COUNT(*) AS orders, MAX(o_totalprice) AS highest FROM orders
       GROUP BY o_custkey""",
)
def query_to_table(spark, sf):
    by_customer = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("highest"))
    )
    return materialize(by_customer, scratch_table(spark, "by_customer"))


@query("S11_csv_extract", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_extract(spark, sf):
    name, path = scratch_table(spark, "supplier"), scratch_path(spark, "extract")
    supplier = materialize(table(spark, sf, "supplier"), name)
    export_table(spark, name, path, sep="|")
    return spark.read.schema(supplier.schema).option("header", True).option("sep", "|").csv(path)


@query("S12_table_copy", with_ctes(SQL_EVENT_DAYS) + "SELECT * FROM event_days")
def table_copy(spark, sf):
    source = scratch_table(spark, "days")
    target = source + "_copy"
    write_partitioned(event_days(spark, sf), source)
    copy_table(spark, source, target)
    copy_table(spark, source, target, overwrite=True)
    return spark.table(target)


@query(
    "S13_publish_on_arrival",
    """SELECT event_type AS target, CAST(user_id AS VARCHAR) AS user_id,
              CAST(COUNT(*) AS VARCHAR) AS n FROM events GROUP BY event_type, user_id""",
)
def publish_on_arrival(spark, sf):
    arrivals = scratch_path(spark, "arrivals")
    counts = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    # Each event type is one published table, uploaded twice; the second upload is the right one.
    for run, value in (("1", F.lit(0)), ("2", F.col("n"))):
        uploads = counts.select(
            F.concat("event_type", F.lit(".csv")).alias("name"), F.lit(run).alias("run"), "user_id", value.alias("n")
        )
        uploads.write.mode("append").option("header", True).partitionBy("name", "run").csv(arrivals)
    out, state = scratch_path(spark, "published"), scratch_path(spark, "state")
    schema = text_schema(("user_id", "n"))
    publish_stream(spark, arrivals, out, state, schema, name_from="folder").awaitTermination()
    return published(spark, out)


@query("S14_backfill", with_ctes(SQL_REPORT_TEXTS) + SQL_STANDARD_REPORTS)
def backfill(spark, sf):
    base, name = report_folder(spark, sf), scratch_table(spark, "daily_global")
    first, last = event_days_range(spark, sf)
    ingest_daily_reports(spark, base, name, GLOBAL_DAILY, first)
    ingest_daily_reports(spark, base, name, GLOBAL_DAILY, str(first), str(last))
    reloaded = [first + timedelta(days=i) for i in range((last - first).days // 2)]
    ingest_daily_reports(spark, base, name, GLOBAL_DAILY, [first, *reloaded])
    return spark.table(name).withColumn("last_update", F.col("last_update").cast("timestamp_ntz"))

import datetime as dt
import os

from helpers import rows
from pyspark.sql import functions as F

from casetrends.plans import run_daily_reports, run_global, run_us
from casetrends.streaming import publish_stream, published

NOW = dt.datetime(2020, 5, 1, 17, tzinfo=dt.timezone.utc)
IDS = "UID,iso2,iso3,code3,FIPS,Admin2,Province_State,Country_Region,Lat,Long_,Combined_Key"


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.write(text)


def test_files_to_published_snapshot(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS run_us")
    place = '84001001,US,USA,840,1001.0,Autauga,Alabama,US,32.5,-86.6,"Autauga, Alabama, US"'
    for run, third in (("20200124", 6), ("20200125", 8)):
        put(folder, "confirmed.csv", f"{IDS},1/22/20,1/23/20,1/24/20\n{place},1,3,{third}\n")
        put(folder, "deaths.csv", f"{IDS},Population,1/22/20,1/23/20,1/24/20\n{place},100,0,0,2\n")
        current = run_us(
            spark, f"{folder}/confirmed.csv", f"{folder}/deaths.csv", "run_us",
            f"{folder}/uploads/us_current/{run}", NOW,
        )
    assert spark.table("run_us.us_series").count() == 3
    assert spark.table("run_us.us_deaths_raw").first().FIPS == 1001
    picked = current.select("dt", "total_confirmed", "daily_new_confirmed", "daily_new_confirmed_7d_ma", "incident_rate")
    assert rows(picked) == [(dt.date(2020, 1, 24), 8, 5, 2.7, 0.08)]
    publish_stream(
        spark, f"{folder}/uploads", f"{folder}/out", f"{folder}/state", name_from="folder"
    ).awaitTermination()
    sheet = published(spark, f"{folder}/out", "us_current")
    assert rows(sheet.select("combined_key", "total_confirmed")) == [("Autauga, Alabama, US", "8")]


def test_daily_files_to_global_series(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS run_global")
    for day, total in (("04-12-2020", 5), ("04-13-2020", 9)):
        put(folder, f"us/{day}.csv", f"Province_State,Country_Region,Confirmed,Incident_Rate\nOhio,US,{total},30\nRecovered,US,1,\n")
        put(folder, f"world/{day}.csv", f"Province_State,Country_Region,Confirmed\n,Aland,{total * 2}\nOhio,US,{total}\n")
    run_daily_reports(spark, f"{folder}/us", f"{folder}/world", "run_global", "2020-04-12", "2020-04-13")
    series = run_global(spark, "run_global", f"{folder}/extract", NOW)
    picked = series.select("dt", "province_state", "country_region", "population", "daily_new_confirmed")
    assert rows(picked, "country_region", "dt") == [
        (dt.date(2020, 4, 12), None, "Aland", None, 10),
        (dt.date(2020, 4, 13), None, "Aland", None, 8),
        (dt.date(2020, 4, 12), "Ohio", "US", 16667, 5),
        (dt.date(2020, 4, 13), "Ohio", "US", 30000, 4),
    ]
    assert spark.read.option("header", True).csv(f"{folder}/extract").count() == 4


def test_default_day_is_yesterday(spark, folder):
    spark.sql("CREATE DATABASE IF NOT EXISTS run_default")
    day = dt.date.today() - dt.timedelta(days=1)
    for kind in ("us", "world"):
        put(folder, f"{kind}/{day:%m-%d-%Y}.csv", "Country_Region,Confirmed\nX,1\n")
    run_daily_reports(spark, f"{folder}/us", f"{folder}/world", "run_default")
    assert rows(spark.table("run_default.daily_us").select(F.max("report_dt"))) == [(day,)]

import datetime as dt
import re

import pytest
from helpers import day, plan, rows
from pyspark.sql import functions as F

from casetrends.functions.dates import day_column
from casetrends.operators import latest_snapshot, unpivot_wide
from casetrends.plans import (
    global_series_basic,
    global_series_daily,
    global_series_wide,
    state_rollup,
    us_current,
    us_series,
    us_series_from_long,
)
from casetrends.schemas import US_PLACE, US_SERIES_COLUMNS

NOW = dt.datetime(2020, 5, 1, 17, tzinfo=dt.timezone.utc)
US_HEAD = "county string, province_state string, country_region string, latitude double, longitude double, combined_key string"


def us(spark, table, first=1, population=False):
    """``{county: (totals, population)}`` as a wide frame."""
    size = max(len(t) for t, _ in table.values())
    days = [day_column(day(first + i)) for i in range(size)]
    head = US_HEAD + (", population bigint" if population else "")
    data = [
        (c, "S", "US", 1.0, 2.0, f"{c}, S, US", *([p] if population else []), *t)
        for c, (t, p) in table.items()
    ]
    return spark.createDataFrame(data, head + "".join(f", {d} bigint" for d in days))


@pytest.fixture(scope="module")
def counties(spark):
    confirmed = {"a": ([10, 12, 12, 11], None), "b": ([None, 0, 4, 4], None)}
    deaths = {"a": ([0, 1, 1, 2], 400), "c": ([1, 1, 1, 1], 0)}
    return us(spark, confirmed), us(spark, deaths, population=True)


def test_us_series(spark, counties):
    got = us_series(*counties, now=NOW)
    assert got.columns == list(US_SERIES_COLUMNS)
    picked = got.select("county", "dt", "population", "total_confirmed", "total_deaths", "daily_new_confirmed", "daily_new_confirmed_7d_ma", "incident_rate", "case_fatality_rate")
    assert rows(picked, "county", "dt") == [
        ("a", day(1), 400, 10, 0, 10, 10.0, 0.025, 0.0),
        ("a", day(2), 400, 12, 1, 2, 6.0, 0.03, 0.0833),
        ("a", day(3), 400, 12, 1, 0, 4.0, 0.03, 0.0833),
        ("a", day(4), 400, 11, 2, -1, 2.8, 0.0275, 0.1818),
        ("b", day(1), None, 0, 0, 0, 0.0, None, None),
        ("b", day(2), None, 0, 0, 0, 0.0, None, None),
        ("b", day(3), None, 4, 0, 4, 1.3, None, 0.0),
        ("b", day(4), None, 4, 0, 0, 1.0, None, 0.0),
        ("c", day(1), 0, 0, 1, 0, 0.0, None, None),
        ("c", day(2), 0, 0, 1, 0, 0.0, None, None),
        ("c", day(3), 0, 0, 1, 0, 0.0, None, None),
        ("c", day(4), 0, 0, 1, 0, 0.0, None, None),
    ]
    assert {(r.last_updated_dt, r.last_updated_ts) for r in got.collect()} == {(day(4), dt.datetime(2020, 5, 1, 10))}


def test_us_series_from_long_is_the_same(spark, counties):
    confirmed, deaths = counties
    longs = [unpivot_wide(df, list(US_PLACE), m) for df, m in ((confirmed, "confirmed"), (deaths, "deaths"))]
    people = deaths.select("combined_key", "population")
    want = rows(us_series(confirmed, deaths, NOW), "combined_key", "dt")
    for unique in (False, True):
        got = us_series_from_long(*longs, people, NOW, one_row_per_day=unique)
        assert rows(got, "combined_key", "dt") == want


def test_frames_that_end_on_different_days(spark):
    confirmed = us(spark, {"a": ([1, 2, 3], None)})
    deaths = us(spark, {"a": ([0, 1], 5), "b": ([1, 1], 5)}, population=True)
    got = us_series(confirmed, deaths, NOW).select("county", "dt", "total_confirmed", "total_deaths", "last_updated_dt")
    assert rows(got, "county", "dt") == [
        ("a", day(1), 1, 0, day(3)),
        ("a", day(2), 2, 1, day(3)),
        ("a", day(3), 3, 0, day(3)),
        ("b", day(1), 0, 1, day(3)),
        ("b", day(2), 0, 1, day(3)),
    ]
    assert rows(us_current(confirmed, deaths, NOW).select("county")) == [("a",)]


def test_repeated_county_in_deaths_repeats_rows(spark):
    confirmed = us(spark, {"a": ([1], None)})
    deaths = us(spark, {"a": ([0], 5)}, population=True)
    assert us_series(confirmed, deaths.union(deaths), NOW).count() == 4


def test_snapshot_of_a_long_series_reads_only_what_it_needs(spark, folder):
    totals = [i * i % 97 for i in range(60)]
    us(spark, {"a": (totals, None), "b": (totals[::-1], None)}).write.parquet(f"{folder}/c")
    us(spark, {"a": (totals[5:] + totals[:5], 7)}, population=True).write.parquet(f"{folder}/d")
    confirmed, deaths = spark.read.parquet(f"{folder}/c"), spark.read.parquet(f"{folder}/d")
    current = us_current(confirmed, deaths, NOW)
    want = us_series(confirmed, deaths, NOW).filter(F.col("dt") == day(60))
    assert rows(current, "county") == rows(want, "county")
    assert len(rows(current, "county")) == 2
    read = set(re.findall(r"dt_\d{8}", " ".join(re.findall(r"ReadSchema: \S+", plan(current)))))
    assert read <= {day_column(day(i)) for i in range(32, 61)}


@pytest.mark.parametrize("size", [1, 2, 7, 8, 28, 29, 40])
def test_snapshot_from_columns_is_the_snapshot(spark, size):
    totals = [(i * 37 + 11) % 101 + i for i in range(size)]
    confirmed = us(spark, {"a": (totals, None), "b": ([None, *totals[1:]], None)})
    deaths = us(spark, {"a": (totals[::-1], 7), "c": (totals, 0)}, population=True)
    want = us_series(confirmed, deaths, NOW).filter(F.col("dt") == F.col("last_updated_dt"))
    for unique in (False, True):
        got = us_current(confirmed, deaths, NOW, one_row_per_place=unique)
        assert rows(got, "county") == rows(want, "county")


def test_one_row_per_place(spark, counties):
    got = us_series(*counties, NOW, one_row_per_place=True)
    assert rows(got, "combined_key", "dt") == rows(us_series(*counties, NOW), "combined_key", "dt")
    confirmed, deaths = counties
    for plan_of in (us_series, us_current):
        with pytest.raises(Exception, match="occurs twice"):
            plan_of(confirmed, deaths.union(deaths), NOW, one_row_per_place=True).collect()


def test_key_without_the_last_day_is_not_in_the_snapshot(spark):
    df = spark.createDataFrame([("x", day(1)), ("x", day(2)), ("y", day(1))], "k string, dt date")
    assert rows(latest_snapshot(df)) == [("x", day(2))]
    assert rows(latest_snapshot(df, last=day(1)), "k") == [("x", day(1)), ("y", day(1))]


def test_us_plan_brings_nothing_to_one_task(spark, counties):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(us_series(*counties))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SinglePartition" not in text and "NestedLoop" not in text and "Cartesian" not in text
    # Both sides, their joined rows and the population; nothing after the unpivot.
    assert text.count("Exchange hashpartitioning") == 4
    assert "Exchange" not in text[: text.index("Generate")]


def test_rollup_to_states(spark, counties):
    got = state_rollup(us_series(*counties))
    assert rows(got.filter(F.col("dt") == day(4))) == [(day(4), "S", "US", 400, 15, 3)]
    assert "Window" not in plan(got)


REPORT = (
    "report_dt date, province_state string, country_region string, latitude double, longitude double, "
    "confirmed bigint, deaths bigint, recovered bigint, active bigint, incident_rate double, "
    "case_fatality_ratio double, total_test_results bigint, testing_rate double"
)


def report(d, state, country, confirmed, rate, ratio=None, tests=None, testing=None):
    return (day(d), state, country, 1.0, 2.0, confirmed, 0, None, 1, rate, ratio, tests, testing)


def test_global_series_from_reports(spark):
    us_rows = spark.createDataFrame(
        [
            report(1, "Ohio", "US", 5, 30.0, 1.23456, 50, 300.0),
            report(2, "Ohio", "US", 8, 100001.0, None, 60, 100001.0),
            report(1, "Recovered", "US", 99, 1.0),
            report(1, None, "US", 99, 1.0),
        ],
        REPORT,
    )
    world = spark.createDataFrame(
        [report(1, None, "Aland", 7, None), report(3, None, "Aland", 4, 0.0), report(1, "X", "US", 1, 1.0), report(1, "X", None, 1, 1.0)],
        REPORT,
    )
    got = global_series_daily(us_rows, world, now=NOW)
    picked = got.select("province_state", "dt", "population", "total_confirmed", "daily_new_confirmed", "daily_new_recovered", "daily_new_confirmed_7d_ma", "incident_rate", "case_fatality_rate", "total_test_results", "testing_rate", "last_updated_dt")
    assert rows(picked, "country_region", "dt") == [
        (None, day(1), None, 7, 7, None, 7.0, None, None, None, None, day(3)),
        (None, day(3), None, 4, -3, None, 2.0, 0.0, None, None, None, day(3)),
        ("Ohio", day(1), 16667, 5, 5, None, 5.0, 0.0003, 1.2346, 50, 0.003, day(3)),
        ("Ohio", day(2), None, 8, 3, None, 4.0, None, None, 60, None, day(3)),
    ]
    assert "daily_new_recovered_7d_ma" in got.columns and len(got.columns) == 28


def test_repeated_report_rows_can_be_collapsed(spark):
    world = spark.createDataFrame([report(1, None, "Aland", 7, None), report(1, None, "Aland", 9, None)], REPORT)
    got = global_series_daily(world.limit(0), world, now=NOW, collapse=True)
    assert rows(got.select("total_confirmed", "daily_new_confirmed")) == [(9, 9)]


def test_collapsed_report_rows_stay_whole(spark):
    low, high = list(report(1, None, "Aland", 7, 30.0, 2.0)), list(report(1, None, "Aland", 9, None, 1.0))
    low[6], high[6] = 5, 1
    world = spark.createDataFrame([low, high], REPORT)
    got = global_series_daily(world.limit(0), world, now=NOW, collapse=True, last_day=F.lit(day(4)))
    picked = got.select("total_confirmed", "total_deaths", "case_fatality_rate", "population", "last_updated_dt")
    assert rows(picked) == [(9, 1, 1.0, None, day(4))]


def test_known_last_day_spares_a_second_reading(spark, tmp_path):
    spark.createDataFrame([report(1, None, "Aland", 7, None)], REPORT).write.parquet(f"{tmp_path}/r")
    world = spark.read.parquet(f"{tmp_path}/r")
    read = [
        plan(global_series_daily(world, world, now=NOW, last_day=last)).count("FileScan")
        for last in (None, F.lit(day(1)))
    ]
    assert read == [4, 2]


def world_wide(spark, data):
    head = "province_state string, country_region string, latitude double, longitude double"
    return spark.createDataFrame(data, head + ", dt_20200122 bigint, dt_20200123 bigint")


def test_global_series_from_wide_files(spark):
    confirmed = world_wide(spark, [("Alberta", "Canada", 1.0, 1.0, 2, 5), (None, "Aland", 0.0, 0.0, 10, 20)])
    deaths = world_wide(spark, [("Alberta", "Canada", 1.0, 1.0, 1, 1), ("", "Aland", 0.0, 0.0, 1, 5)])
    recovered = world_wide(spark, [(None, "Canada", 9.0, 9.0, 3, 4)])
    got = global_series_wide(confirmed, deaths, recovered, now=NOW)
    picked = got.select("province_state", "country_region", "dt", "total_confirmed", "total_deaths", "total_recovered", "daily_new_recovered", "case_fatality_rate")
    assert rows(picked, "country_region", "province_state", "dt") == [
        ("", "Aland", day(1), 10, 1, 0, 0, 0.1),
        ("", "Aland", day(2), 20, 5, 0, 0, 0.25),
        (None, "Canada", day(1), 0, 0, 3, 3, None),
        (None, "Canada", day(2), 0, 0, 4, 1, None),
        ("Alberta", "Canada", day(1), 2, 1, 0, 0, 0.5),
        ("Alberta", "Canada", day(2), 5, 1, 0, 0, 0.2),
    ]
    basic = global_series_basic(confirmed, deaths, recovered, now=NOW)
    assert basic.columns == [
        "dt", "province_state", "country_region", "latitude", "longitude", "confirmed", "deaths",
        "recovered", "confirmed_new", "deaths_new", "recovered_new", "last_updated_ts",
    ]
    assert rows(basic.filter("country_region = 'Aland'").select("confirmed_new", "deaths_new"), "dt") == [(10, 1), (10, 4)]


@pytest.mark.parametrize("merge", [True, False])
def test_global_key_that_confirmed_lacks(spark, merge):
    none = world_wide(spark, [])
    b = world_wide(spark, [("P", "Q", 1.0, 1.0, 1, 2)])
    got = global_series_wide(none, b, b, coalesce_keys=merge, now=NOW)
    assert rows(got.select("total_deaths", "total_recovered", "daily_new_deaths"), "dt") == [(1, 1, 1), (2, 2, 1)]


def test_filters_on_labels_pass_the_window(spark):
    from querybook.views import reports

    plan = reports(spark, "/root/testdata/sf0.001").filter("country_region = 'US'")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in text
    above = text.split("Window", 1)[0]
    assert "Filter" not in above


def _files(spark, name):
    import os

    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    top = found["data_type"].removeprefix("file:")
    return {
        (re.search(r"dt=([-0-9]+)", d)[1], f): os.stat(f"{d}/{f}").st_mtime_ns
        for d, _, files in os.walk(top) for f in files if f.endswith(".parquet")
    }


def test_refresh_equals_a_rebuild_and_leaves_earlier_files(spark):
    import random

    from casetrends.operators import series_metrics
    from casetrends.plans import refresh_series
    from casetrends.sources import replace_partitions

    random.seed(6)
    spark.sql("CREATE DATABASE IF NOT EXISTS refreshed")
    name, keys = "refreshed.series", ["k"]
    schema = "k string, dt date, total_a bigint, note string"
    data = {
        (k, d): random.choice((None, random.randint(0, 50)))
        for k in ("x", None, "sparse", "short")
        for d in range(70)
        if random.random() < {"sparse": 0.15, "short": 0.04}.get(k, 0.9)
    }
    frame = lambda found: spark.createDataFrame(
        [(k, day(d), v, "n") for (k, d), v in found.items()], schema
    )
    replace_partitions(series_metrics(frame(data), keys, ["a"]), name, "dt")
    before = _files(spark, name)
    since = 50
    corrected = {at: v for at, v in data.items() if at[1] < since} | {
        (k, d): (v or 0) + 7 for (k, d), v in data.items() if d >= since and d != 55
    } | {("new", 60): 1, ("x", 71): 2}
    fresh = frame({at: v for at, v in corrected.items() if at[1] >= since})
    for _ in range(2):
        refresh_series(spark, name, fresh, keys, ["a"], day(since))
        want = series_metrics(frame(corrected), keys, ["a"])
        got = spark.table(name).select(*want.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    after = _files(spark, name)
    early = {at: t for at, t in before.items() if at[0] < str(day(since))}
    assert early and early == {at: t for at, t in after.items() if at[0] < str(day(since))}
    with pytest.raises(ValueError, match="unnamed day"):
        refresh_series(spark, name, frame({("x", 1): 1}), keys, ["a"], day(since))

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F
from helpers import day, exchanges, plan, rows

from casetrends.operators import (
    daily_delta,
    latest_rows,
    on_calendar,
    ranged_series_metrics,
    series_metrics,
    trailing_avg,
    with_global_max,
)


def totals(spark, values, key="x"):
    data = [(key, day(i), v) for i, v in enumerate(values, start=1)]
    return spark.createDataFrame(data, "combined_key string, dt date, total_confirmed bigint")


def test_delta_fallback_and_average(spark):
    df = series_metrics(totals(spark, [10, 12, 12, 11]), ["combined_key"], ["confirmed"])
    got = rows(df.select("dt", "daily_new_confirmed", "daily_new_confirmed_7d_ma"), "dt")
    assert [r[1] for r in got] == [10, 2, 0, -1]
    assert [r[2] for r in got] == [10.0, 6.0, 4.0, 2.8]


def test_delta_without_fallback_starts_with_null(spark):
    df = daily_delta(totals(spark, [10, 12]), ["combined_key"], "confirmed")
    assert [r[-1] for r in rows(df, "dt")] == [None, 2]


def test_latest_rows_are_whole(spark):
    data = [
        ("x", day(1), 2, "late", None),
        ("x", day(1), 1, "early", 9),
        ("x", day(1), None, "never", 10),
        ("x", day(2), 3, "a", 1),
        ("x", day(2), 3, "b", 0),
        ("x", day(2), 3, "b", 0),
        (None, day(1), 1, "c", 5),
        ("x", None, 1, "d", 6),
    ]
    df = spark.createDataFrame(data, "`k.k` string, dt date, stamp int, `a b` string, total bigint")
    got = latest_rows(df, ["k.k"], ["stamp"])
    assert got.columns == df.columns
    found = [tuple(r) for r in got.collect()]
    assert len(found) == 4 and set(found) == {data[0], data[4], data[6], data[7]}


def test_latest_rows_of_keys_alone(spark):
    df = spark.createDataFrame([("x", day(1)), ("x", day(1)), ("x", None)], "k string, dt date")
    assert latest_rows(df, ["k"]).count() == 2
    assert latest_rows(df.limit(0), ["k"]).count() == 0


def test_null_total_makes_the_next_total_look_new(spark):
    df = daily_delta(totals(spark, [10, None, 30]), ["combined_key"], "confirmed", fallback=True)
    assert [r[-1] for r in rows(df, "dt")] == [10, None, 30]


def test_average_frames_are_rows_and_skip_nulls(spark):
    data = [("x", day(i * 10), v) for i, v in enumerate([7, None, 14, 0, 0, 0, 0, 0, 21])]
    df = spark.createDataFrame(data, "combined_key string, dt date, daily_new_confirmed bigint")
    got = rows(trailing_avg(df, ["combined_key"], "confirmed", rows=7), "dt")
    assert [r[-1] for r in got] == [7.0, 7.0, 10.5, 7.0, 5.3, 4.2, 3.5, 2.3, 5.0]


def test_28_rows(spark):
    values = list(range(1, 41))
    df = spark.createDataFrame(
        [("x", day(i), v) for i, v in enumerate(values)],
        "combined_key string, dt date, daily_new_confirmed bigint",
    )
    got = [r[-1] for r in rows(trailing_avg(df, ["combined_key"], "confirmed", rows=28), "dt")]
    for i in range(40):
        frame = values[max(0, i - 27) : i + 1]
        assert got[i] == round(sum(frame) / len(frame) + 1e-9, 1)


def test_null_province_is_one_series_per_country(spark):
    data = [(None, "A", day(1), 1), (None, "A", day(2), 4), (None, "B", day(1), 9), ("", "A", day(2), 7)]
    df = spark.createDataFrame(
        data, "province_state string, country_region string, dt date, total_confirmed bigint"
    )
    got = daily_delta(df, ["province_state", "country_region"], "confirmed", fallback=True)
    found = {(r.province_state, r.country_region, r.dt): r.daily_new_confirmed for r in got.collect()}
    assert found == {
        (None, "A", day(1)): 1,
        (None, "A", day(2)): 3,
        (None, "B", day(1)): 9,
        ("", "A", day(2)): 7,
    }


def test_new_counts_add_up_to_the_last_total(spark):
    df = totals(spark, [3, 8, 8, 5, 20]).unionByName(totals(spark, [1, 1, 2], key="y"))
    new = daily_delta(df, ["combined_key"], "confirmed", fallback=True)
    got = new.groupBy("combined_key").agg(
        F.sum("daily_new_confirmed"), F.max_by("total_confirmed", "dt")
    )
    assert rows(got, "combined_key") == [("x", 20, 20), ("y", 2, 2)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=45))
def test_averages_by_difference_are_the_averages(spark, values):
    df = totals(spark, values)
    slow = series_metrics(df, ["combined_key"], ["confirmed"])
    fast = series_metrics(df, ["combined_key"], ["confirmed"], filled=True)
    assert rows(fast.select(slow.columns), "dt") == rows(slow, "dt")


def test_repeated_day_is_refused(spark):
    df = totals(spark, [1, 2]).union(totals(spark, [5]))
    with pytest.raises(Exception, match="a day occurs twice"):
        series_metrics(df, ["combined_key"], ["confirmed"], unique=True).collect()
    kept = series_metrics(totals(spark, [1, 2]), ["combined_key"], ["confirmed"], unique=True)
    assert kept.count() == 2 and "repeated__" not in kept.columns


def test_all_windows_share_one_exchange(spark):
    df = series_metrics(totals(spark, [1, 2, 3]), ["combined_key"], ["confirmed"])
    assert exchanges(df) == ["hashpartitioning"]


def test_filled_series_need_one_window_operator(spark):
    df = series_metrics(totals(spark, [1, 2, 3]), ["combined_key"], ["confirmed"], filled=True, unique=True)
    assert len(re.findall(r"\+- Window \[", plan(df))) == 1


def test_global_max_is_no_single_partition_window(spark):
    df = with_global_max(totals(spark, [1, 2, 3]))
    assert {r.last_updated_dt for r in df.collect()} == {day(3)}
    main = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in main and "Join" not in main


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_ranges_equal_the_plain_windows(spark, folder, partitions):
    """Few long series with days that repeat, one of them NULL, over more ranges than it has weeks."""
    import random

    random.seed(partitions)
    data = [
        (key, day(random.randint(0, 20)), random.choice((None, 1, 5, 9)), n)
        for key, size in (("hot", 300), (None, 60), ("one", 1), ("few", 9))
        for n in range(size)
    ]
    data += data[:5]
    df = spark.createDataFrame(data, "k string, dt date, total_a bigint, total_b bigint").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ranged_series_metrics(df, ["k"], ["a", "b"], f"{folder}/ranges", rows=(7, 28))
        got = sorted(map(repr, got.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")
    # The plain windows over the same total order.
    order = Window.orderBy("dt", F.col("total_a"), F.col("total_b"))
    placed = df.withColumn("n", F.row_number().over(order))
    want = series_metrics(placed, ["k"], ["a", "b"], "n", rows=(7, 28)).drop("n")
    assert got == sorted(map(repr, want.collect()))


def test_ranges_spread_one_series(spark, folder):
    df = spark.range(20_000).select(
        F.lit("x").alias("k"), F.lit(day(1)).alias("dt"), F.col("id").alias("total_a")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ranged_series_metrics(df, ["k"], ["a"], f"{folder}/ranges")
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 15_000


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.one_of(st.none(), st.integers(0, 9)), min_size=1, max_size=12))
def test_calendar_has_every_day_once(spark, found):
    df = spark.createDataFrame(
        [("x", day(d), v) for d, v in found.items()] + [("y", day(3), 5)],
        "k string, dt date, total_a bigint",
    )
    last = None
    carried, blank = [], []
    for d in range(min(found), max(found) + 1):
        last = found.get(d, last)
        carried.append((day(d), last))
        blank.append((day(d), found.get(d)))
    for fill, want in (("ffill", carried), (None, blank)):
        got = on_calendar(df, ["k"], fill=fill)
        assert rows(got.where("k = 'x'").select("dt", "total_a"), "dt") == want
        assert rows(got.where("k = 'y'").select("total_a")) == [(5,)]
    dense = series_metrics(df, ["k"], ["a"], rows=(7,), calendar=True).where("k = 'x'")
    plain = spark.createDataFrame([("x", d, v) for d, v in carried], "k string, dt date, total_a bigint")
    assert rows(dense, "dt") == rows(series_metrics(plain, ["k"], ["a"], rows=(7,)), "dt")


def test_calendar_until_a_day(spark):
    df = spark.createDataFrame([("x", day(1), 4), ("y", None, 7)], "k string, dt date, total_a bigint")
    got = on_calendar(df, ["k"], until=F.lit(day(3)))
    assert rows(got, "k", "dt") == [("x", day(1), 4), ("x", day(2), 4), ("x", day(3), 4), ("y", None, 7)]
    with pytest.raises(ValueError):
        on_calendar(df, ["k"], fill="linear")

import datetime as dt

import pytest
from helpers import day, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.functions import (
    date_span,
    has_suffix,
    implied_population,
    local_stamp,
    parse_dated_name,
    parse_timestamp,
    per_person,
    round_to_long,
    safe_ratio,
    strip_suffix,
    strip_utc_offset,
    typed,
    yesterday,
)
from casetrends.functions.dates import expand_days


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_safe_ratio(spark):
    df = spark.createDataFrame([(10, 0), (10, None), (10, 400), (0, 3)], "n bigint, d bigint")
    got = [r.v for r in df.select(safe_ratio(F.col("n"), F.col("d")).alias("v")).collect()]
    assert got == [None, None, 0.025, 0.0]


@pytest.mark.parametrize("value, want", [(2.7, 3), (2.5, 3), (-2.5, -3), (2.4, 2), (None, None)])
def test_round_to_long(spark, value, want):
    assert one(spark, round_to_long(F.lit(value).cast("double"))) == want


def test_implied_population_rounds(spark):
    rate = per_person(F.lit(30.0))
    assert one(spark, implied_population(F.lit(5), rate)) == 16667
    assert one(spark, implied_population(F.lit(5), F.lit(0.0))) is None
    assert one(spark, implied_population(F.lit(5), F.lit(None).cast("double"))) is None


@pytest.mark.parametrize("rate, want", [(100001.0, None), (100000.0, 1.0), (None, None), (30.0, 0.0003)])
def test_implausible_rates(spark, rate, want):
    assert one(spark, per_person(F.lit(rate).cast("double"))) == want


def test_local_stamp(spark):
    for now, want in [("2020-05-01 17:00:00", 10), ("2020-12-01 17:00:00", 9)]:
        got = one(spark, local_stamp(F.lit(now).cast("timestamp")))
        assert (got.hour, got.minute) == (want, 0)
    assert one(spark, local_stamp()) is not None
    assert one(spark, strip_utc_offset(F.lit("2020-05-01 10:00:00-07"))) == "2020-05-01 10:00:00"
    assert one(spark, strip_utc_offset(F.lit("2020-05-01"))) == "2020-05-01"[:-3]


def test_dates(spark):
    assert one(spark, parse_dated_name(F.lit("dt_20200122"))) == day(1)
    assert one(spark, date_span(F.lit(day(1)), F.lit(day(3)))) == [day(1), day(2), day(3)]
    assert one(spark, date_span(F.lit(day(3)), F.lit(day(1)))) == []
    assert one(spark, yesterday(F.lit(day(2)))) == day(1)
    assert one(spark, yesterday()) == one(spark, F.current_date()) - dt.timedelta(days=1)


def test_expand_days():
    assert expand_days("2020-01-22") == [day(1)]
    assert expand_days(day(1), "2020-01-24") == [day(1), day(2), day(3)]
    assert expand_days(["2020-01-22", day(5)]) == [day(1), day(5)]
    assert expand_days(day(3), day(1)) == []
    for bad in (20200122, None, [1]):
        with pytest.raises(TypeError):
            expand_days(bad)
    with pytest.raises(ValueError):
        expand_days("22-01-2020")


def test_suffix(spark):
    df = spark.createDataFrame([("a.csv",), ("a.csv.gz",), ("acsv",), ("a.b.csv",)], "n string")
    got = df.select(has_suffix(F.col("n")), strip_suffix(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(True, "a"), (False, "a.csv.gz"), (False, "acsv"), (True, "a.b")]


TEXTS = ["12", "12.0", "1e3", " 7 ", "", "NA", "NaN", None]


def test_typed_long(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r.v for r in df.select(typed("t", T.LongType()).alias("v")).collect()]
    assert got == [12, 12, 1000, 7, None, None, None, None]
    assert one(spark, typed("'9007199254740993'", T.LongType())) == 9007199254740993


@pytest.mark.parametrize("text, dtype", [("x", T.LongType()), ("1.5", T.LongType()), ("x", T.DoubleType()), ("x", T.TimestampType())])
def test_bad_text(spark, text, dtype):
    assert one(spark, typed(f"'{text}'", dtype, "permissive")) is None
    with pytest.raises(Exception, match="Confirmed: not a"):
        one(spark, typed(f"'{text}'", dtype, label="Confirmed"))


def test_typed_others(spark):
    assert one(spark, typed("'1.5'", T.DoubleType())) == 1.5
    assert one(spark, typed("'nan'", T.DoubleType())) is None
    assert one(spark, typed("'Namibia'", T.StringType())) == "Namibia"
    assert one(spark, typed("'null'", T.StringType())) is None
    with pytest.raises(ValueError):
        typed("x", T.LongType(), "lenient")


@pytest.mark.parametrize(
    "text, want",
    [
        ("1/22/2020 17:00", dt.datetime(2020, 1, 22, 17, 0)),
        ("2020-02-02T23:43:02", dt.datetime(2020, 2, 2, 23, 43, 2)),
        ("3/22/20 23:45", dt.datetime(2020, 3, 22, 23, 45)),
        ("2020-03-23 23:19:34", dt.datetime(2020, 3, 23, 23, 19, 34)),
        ("2020-03-23", dt.datetime(2020, 3, 23)),
        ("soon", None),
    ],
)
def test_timestamps(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(parse_timestamp("t").alias("v"))
    assert rows(got.select(F.col("v").cast("timestamp_ntz"))) == [(want,)]

import pytest
from helpers import day, plan, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from casetrends.functions.dates import date_header, day_column
from casetrends.operators import column_slice, dated_structs, profile, unnest, unpivot_wide


def wide(spark):
    return spark.createDataFrame(
        [("x", 1, None), ("y", None, 7)], "combined_key string, dt_20200122 bigint, dt_20200123 bigint"
    )


def test_unpivot_keeps_missing_values(spark):
    got = rows(unpivot_wide(wide(spark), ["combined_key"], "confirmed"), "combined_key", "dt")
    assert got == [(day(1), "x", 1), (day(2), "x", None), (day(1), "y", None), (day(2), "y", 7)]


def test_unpivot_does_not_shuffle(spark):
    assert "Exchange" not in plan(unpivot_wide(wide(spark), ["combined_key"], "confirmed"))


def test_struct_array_and_unnest(spark):
    df = dated_structs(wide(spark), ["dt_20200122", "dt_20200123"], "deaths")
    first = df.filter("combined_key = 'x'").first()
    assert [tuple(s) for s in first.arr] == [(day(1), 1), (day(2), None)]
    assert unnest(df.select("combined_key", "arr"), "arr").columns == ["combined_key", "dt", "total_deaths"]


def test_empty_arrays_vanish(spark):
    df = spark.createDataFrame([("x", [])], "k string, arr array<struct<a:int>>")
    assert unnest(df, "arr").count() == 0


@settings(max_examples=8, deadline=None)
@given(values=st.lists(st.lists(st.one_of(st.none(), st.integers(0, 99)), min_size=3, max_size=3), min_size=1, max_size=6))
def test_unpivot_is_rows_times_dates(spark, values):
    columns = [day_column(day(i)) for i in (1, 2, 3)]
    data = [(str(i), *v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k string, " + ", ".join(f"{c} bigint" for c in columns))
    got = {(r.k, r.dt): r.total_x for r in unpivot_wide(df, ["k"], "x").collect()}
    assert got == {(str(i), day(j)): v for i, vs in enumerate(values) for j, v in enumerate(vs, 1)}


def test_date_headers():
    assert date_header("1/22/20") == "dt_20200122"
    assert date_header("12/1/21") == "dt_20211201"
    with pytest.raises(ValueError):
        date_header("Lat")


def test_slice_and_profile(spark):
    df = wide(spark)
    assert column_slice(df, 0, 2).columns == ["combined_key", "dt_20200122"]
    assert rows(profile(df), "position") == [
        (0, "combined_key", "string", 2, 2),
        (1, "dt_20200122", "bigint", 2, 1),
        (2, "dt_20200123", "bigint", 2, 1),
    ]

"""Wide frames have a column for every day that their data reach, whichever days these are."""

import datetime as dt
import os

import duckdb
import pytest
from helpers import rows
from oracle import TABLES, compare, connect

from querybook import ORACLE, QUERIES
from querybook.views import day_columns, us_wide

SF = "/root/testdata/sf0.001"
WIDE = (
    "S1_wide_csv_scan", "P2_date_header_normalize", "P7_replace_column", "P10_column_slice",
    "P12_insert_column_at", "R1_unpivot_wide", "R2_array_of_struct", "R3_unnest", "J3_left_enrich",
    "Q1_us_series", "Q1_us_series_one_row_per_place", "Q2_us_current",
    "Q2_us_current_one_row_per_place", "Q4_global_series_wide", "Q5_global_series_basic",
    "Q7_state_rollup",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


def _tables(folder, events):
    """The driver's tables with other events."""
    for name in TABLES:
        if name != "events":
            os.symlink(f"{SF}/{name}.parquet", f"{folder}/{name}.parquet")
    duckdb.connect().execute(
        f"COPY ({events.format(table=f'{SF}/events.parquet')}) TO '{folder}/events.parquet'"
    )
    return str(folder)


@pytest.fixture(scope="module")
def longer(tmp_path_factory):
    """Events on the day after the last one, and on a day of the next year."""
    late = " UNION ALL ".join(
        f"SELECT * REPLACE (ts + INTERVAL {days} DAY AS ts) FROM (FROM '{{table}}' ORDER BY ts DESC LIMIT 20)"
        for days in (1, 61)
    )
    old = "SELECT * REPLACE (ts - INTERVAL 20 DAY AS ts) FROM (FROM '{table}' ORDER BY ts LIMIT 20)"
    return _tables(
        tmp_path_factory.mktemp("longer"), f"FROM '{{table}}' UNION ALL {late} UNION ALL {old}"
    )


@pytest.mark.parametrize("name", WIDE)
def test_days_beyond_a_month(spark, longer, name):
    assert compare(spark, connect(longer), name, QUERIES[name], ORACLE[name], longer) == []


def test_axis_reaches_every_event(spark, longer):
    con = connect(longer)
    lo, hi = con.execute("SELECT min(ts)::date, max(ts)::date FROM events").fetchall()[0]
    assert (hi - lo).days > 100 and lo.year < hi.year
    columns = day_columns(spark, longer)
    assert (columns[0], columns[-1]) == (f"dt_{lo:%Y%m%d}", f"dt_{hi:%Y%m%d}")
    assert len(columns) == (hi - lo).days + 1
    seen = {
        (u, d): n
        for u, d, n in con.execute(
            "SELECT user_id, ts::date, count(*) FROM events WHERE event_type = 'error' GROUP BY ALL"
        ).fetchall()
    }
    for r in us_wide(spark, longer, "deaths").collect():
        total = None
        for k, c in enumerate(columns):
            n = seen.get((r["UID"], lo + dt.timedelta(days=k)))
            total = (total or 0) + n if n else total
            assert r[c] == total


def test_one_day_only(spark, tmp_path):
    sf = _tables(tmp_path, "FROM '{table}' WHERE ts::date = (SELECT min(ts)::date FROM '{table}')")
    for name in ("P7_replace_column", "R2_array_of_struct", "Q2_us_current", "S1_wide_csv_scan"):
        assert compare(spark, connect(sf), name, QUERIES[name], ORACLE[name], sf) == []
    assert len(day_columns(spark, sf)) == 1
    assert rows(us_wide(spark, sf, "confirmed").groupBy().count())[0][0] > 0

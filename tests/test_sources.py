import datetime as dt
import os
import re

import pytest
from helpers import day, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.plans import ingest_daily_reports
from casetrends.operators import UnknownColumnsError, latest_snapshot
from casetrends.schemas import GLOBAL_DAILY, GLOBAL_IDS, US_DAILY
from casetrends.sources.daily import report_day
from casetrends.sources import (
    copy_table,
    discover_columns,
    export_csv,
    file_headers,
    header_groups,
    latest_partition,
    load,
    materialize,
    read_daily,
    read_wide,
    replace_partitions,
    scratch_path,
    wide_rejects,
    write_partitioned,
    write_wide,
)


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.write(text)


@pytest.fixture(scope="session")
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cases")
    return "cases"


# --- wide files -----------------------------------------------------------------------------------

HEAD = "Province/State,Country/Region,Lat,Long"


def test_wide_files_with_different_last_days(spark, folder):
    put(folder, "a.csv", f"{HEAD},1/22/20,1/23/20\n,A,1.5,-2,1,2\n\"B, east\",C,,,3,\n")
    put(folder, "b.csv", f"{HEAD},1/23/20,1/22/20,1/24/20\n,D,0,0,5,4,6\n")
    got = read_wide(spark, folder, GLOBAL_IDS)
    assert got.columns == [*GLOBAL_IDS.names, "dt_20200122", "dt_20200123", "dt_20200124"]
    assert rows(got, "country_region") == [
        (None, "A", 1.5, -2.0, 1, 2, None),
        ("B, east", "C", None, None, 3, None, None),
        (None, "D", 0.0, 0.0, 4, 5, 6),
    ]


def test_counts_in_other_spellings(spark, folder):
    put(folder, "a.csv", f'{HEAD},1/22/20,1/23/20\n,A,1,2,12.0,1\n,B,1,2,NA,2\n"p, ""q""",C,1,2,x,3\n,D,1,2,4,1.5\n')
    strict = read_wide(spark, folder, GLOBAL_IDS)
    for read in (strict.collect, strict.select("dt_20200123").collect, strict.select("dt_20200122").collect):
        with pytest.raises(Exception, match="(dt_20200122: not a bigint: x|dt_20200123: not a bigint: 1.5)"):
            read()
    got = read_wide(spark, folder, GLOBAL_IDS, mode="permissive")
    assert rows(got.select("province_state", "dt_20200122", "dt_20200123"), "country_region") == [
        (None, 12, 1), (None, None, 2), ('p, "q"', None, 3), (None, 4, None)
    ]
    assert rows(got.select("dt_20200122"), "country_region") == [(12,), (None,), (None,), (4,)]
    put(folder, "a.csv", f"{HEAD},1/22/20\n,A,1,2,12.0\n,B,1,2,NA\n")
    assert rows(read_wide(spark, folder, GLOBAL_IDS).select("dt_20200122"), "country_region") == [(12,), (None,)]


def test_rejected_fields_are_listed(spark, folder):
    put(folder, "a.csv", f"{HEAD},1/22/20,1/23/20\n,A,north,2,12.0,x y\n,B,1,2,7\nS,C,1,2,NA,-,9\n,D,1,2,3,4\n")
    put(folder, "b.csv", f"{HEAD},1/22/20\n,E,1,2,1e99\n,F,1,,\n")
    got = wide_rejects(spark, folder, GLOBAL_IDS)
    found = sorted((r.file_path[-5:], r.record, r.column or "", r.text.strip()) for r in got.collect())
    assert found == [
        ("a.csv", "A,north,2", "dt_20200123", "x y"),
        ("a.csv", "A,north,2", "latitude", "north"),
        ("a.csv", "B,1,2", "", ",B,1,2,7"),
        ("a.csv", "S,C,1,2", "", "S,C,1,2,NA,-,9"),
        ("a.csv", "S,C,1,2", "dt_20200123", "-"),
        ("b.csv", "E,1,2", "dt_20200122", "1e99"),
    ]
    assert got.select("column").count() == 6
    with pytest.raises(Exception, match="(malformed row, [57] fields|not a (bigint|double))"):
        read_wide(spark, folder, GLOBAL_IDS).collect()


def test_wide_header_must_be_dates(spark, folder):
    put(folder, "a.csv", f"{HEAD},Notes\n,A,1,2,3\n")
    with pytest.raises(ValueError):
        read_wide(spark, folder, GLOBAL_IDS)


def test_wide_round_trip(spark, folder):
    df = spark.createDataFrame(
        [("a \"b\", c", "X", 1.0, None, 1, None), (None, "Y", 0.1, 2.0, None, 2)],
        "province_state string, country_region string, latitude double, longitude double, "
        "dt_20200122 bigint, dt_20211201 bigint",
    )
    write_wide(df, f"{folder}/w", GLOBAL_IDS.names)
    assert rows(read_wide(spark, f"{folder}/w", GLOBAL_IDS), "country_region") == rows(df, "country_region")


# --- daily files ----------------------------------------------------------------------------------


@pytest.fixture()
def drift(folder):
    put(folder, "g/01-22-2020.csv", "﻿Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered\nHubei,China,1/22/2020 17:00,444,17,\n")
    put(
        folder,
        "g/03-22-2020.csv",
        "FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Confirmed,Deaths,Recovered,Active,Combined_Key\n"
        '45001.0,Abbeville,South Carolina,US,3/22/20 23:45,34.2,-82.4,1,0,0,0,"Abbeville, South Carolina, US"\n',
    )
    put(
        folder,
        "g/11-10-2020.csv",
        "FIPS,Admin2,Province_State,Country_Region,Last_Update,Lat,Long_,Deaths,Confirmed,Recovered,Active,Combined_Key,Incident_Rate,Case_Fatality_Ratio\n"
        ",,,Aland,2020-11-11 05:25:31,60.1,19.9,1,40,30,9,Aland,133.5,2.5\n",
    )
    return f"{folder}/g"


def test_values_follow_names_across_headers(spark, drift):
    got = read_daily(spark, drift, GLOBAL_DAILY)
    assert got.columns == ["report_dt", *GLOBAL_DAILY.schema.names]
    picked = got.select("report_dt", "FIPS", "county", "province_state", "country_region", "combined_key", "confirmed", "deaths", "recovered", "incident_rate", F.col("last_update").cast("string"))
    assert rows(picked, "report_dt") == [
        (dt.date(2020, 1, 22), None, None, "Hubei", "China", None, 444, 17, None, None, "2020-01-22 17:00:00"),
        (dt.date(2020, 3, 22), 45001, "Abbeville", "South Carolina", "US", "Abbeville, South Carolina, US", 1, 0, 0, None, "2020-03-22 23:45:00"),
        (dt.date(2020, 11, 10), None, None, None, "Aland", "Aland", 40, 1, 30, 133.5, "2020-11-11 05:25:31"),
    ]


def test_swapped_columns(spark, folder):
    put(folder, "01-01-2021.csv", "Confirmed,Deaths\n10,1\n")
    put(folder, "01-02-2021.csv", "Deaths,Confirmed\n2,20\n")
    got = read_daily(spark, folder, US_DAILY).select("confirmed", "deaths")
    assert rows(got, "confirmed") == [(10, 1), (20, 2)]


def test_two_spellings_in_one_file(spark, folder):
    put(folder, "01-01-2021.csv", "UID,Case_Fatality_Ratio,Mortality_Rate\n1,,2.5\n2,3.5,9\n")
    got = read_daily(spark, folder, US_DAILY).select("UID", "case_fatality_ratio")
    assert rows(got, "UID") == [(1, 2.5), (2, 3.5)]


def test_unknown_column_is_refused_by_name_and_file(spark, drift):
    put(os.path.dirname(drift), "g/01-01-2021.csv", "Country_Region,Confirmed,Surprise\nX,1,2\n")
    with pytest.raises(UnknownColumnsError, match=r"01-01-2021\.csv: unknown \['Surprise'\]"):
        read_daily(spark, drift, GLOBAL_DAILY)
    assert read_daily(spark, drift, GLOBAL_DAILY, days=["2020-01-22"]).count() == 1


def test_missing_report(spark, drift):
    with pytest.raises(FileNotFoundError, match="2020-01-23"):
        read_daily(spark, drift, GLOBAL_DAILY, days=["2020-01-22", "2020-01-23"])


def test_bad_number_fails_the_load(spark, folder):
    put(folder, "01-01-2021.csv", "Country_Region,Confirmed\nX,many\n")
    with pytest.raises(Exception, match="Confirmed: not a bigint: many"):
        read_daily(spark, folder, GLOBAL_DAILY).collect()
    assert read_daily(spark, folder, GLOBAL_DAILY, mode="permissive").first().confirmed is None


def test_discover_columns(spark, drift):
    found = {r.column: (r.first_dt, r.last_dt) for r in discover_columns(spark, drift).collect()}
    assert found["Province/State"] == (dt.date(2020, 1, 22), dt.date(2020, 1, 22))
    assert found["Confirmed"] == (dt.date(2020, 1, 22), dt.date(2020, 11, 10))
    assert found["Lat"] == (dt.date(2020, 3, 22), dt.date(2020, 11, 10))
    early = discover_columns(spark, drift, "2020-01-01", "2020-02-01")
    assert early.count() == 6


def test_ingest_and_reload(spark, drift, database):
    name = f"{database}.daily_global"
    ingest_daily_reports(spark, drift, name, GLOBAL_DAILY, ["2020-01-22", "2020-03-22"])
    put(os.path.dirname(drift), "g/03-22-2020.csv", "Country_Region,Confirmed\nUS,5\nUS,6\n")
    for _ in range(2):
        ingest_daily_reports(spark, drift, name, GLOBAL_DAILY, dt.date(2020, 3, 22))
    got = spark.table(name).select("report_dt", "confirmed")
    assert rows(got, "report_dt", "confirmed") == [
        (dt.date(2020, 1, 22), 444),
        (dt.date(2020, 3, 22), 5),
        (dt.date(2020, 3, 22), 6),
    ]


# --- tables ---------------------------------------------------------------------------------------


def days(spark, *data):
    return spark.createDataFrame([(day(d), v) for d, v in data], "dt date, v bigint")


def test_replaced_days_leave_others_alone(spark, database):
    name = f"{database}.replaced"
    replace_partitions(days(spark, (1, 10), (2, 20)), name, "dt")
    for _ in range(2):
        replace_partitions(days(spark, (2, 21), (2, 22), (3, 30)), name, "dt")
    assert rows(spark.table(name).select("dt", "v"), "v") == [(day(1), 10), (day(2), 21), (day(2), 22), (day(3), 30)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_named_day_without_rows_ends_up_empty(spark, database):
    name = f"{database}.emptied"
    replace_partitions(days(spark, (1, 10), (2, 20)), name, "dt")
    replace_partitions(days(spark, (3, 30)), name, "dt", days=[day(2), day(3)])
    assert rows(spark.table(name).select("v"), "v") == [(10,), (30,)]


def test_row_of_an_unnamed_day_is_an_error(spark, database):
    name = f"{database}.strays"
    replace_partitions(days(spark, (1, 1), (2, 2)), name, "dt")
    with pytest.raises(ValueError, match="unnamed day"):
        replace_partitions(days(spark, (1, 3), (2, 4)), name, "dt", days=[day(1)])
    with pytest.raises(ValueError, match="without a day"):
        replace_partitions(days(spark, (1, 3)).withColumn("dt", F.lit(None).cast("date")), name, "dt")
    assert rows(spark.table(name).select("v"), "v") == [(1,), (2,)]


def _folder_of(spark, name):
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return found["data_type"].removeprefix("file:")


def test_replacing_evaluates_its_input_once(spark, database):
    name = f"{database}.once"
    replace_partitions(days(spark, (1, 10), (2, 20)), name, "dt")
    count = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(v):
        count.add(1)
        return v

    fresh = days(spark, (1, 11), (2, 21)).withColumn("v", counted.asNondeterministic()("v"))
    replace_partitions(fresh, name, "dt", days=[day(1), day(2), day(3)])
    assert count.value == 2
    assert rows(spark.table(name).select("v"), "v") == [(11,), (21,)]


def test_replaced_files_go_and_a_failed_load_leaves_all(spark, database):
    name = f"{database}.swapped"
    replace_partitions(days(spark, (1, 10), (2, 20)), name, "dt")
    for v in (21, 22):
        replace_partitions(days(spark, (2, v)), name, "dt")
    kept = [f for _, _, names in os.walk(_folder_of(spark, name)) for f in names if f.endswith(".parquet")]
    assert len(kept) == 2
    broken = days(spark, (2, 23)).withColumn("v", F.raise_error(F.lit("no")).cast("bigint"))
    with pytest.raises(Exception, match="no"):
        replace_partitions(broken, name, "dt")
    assert rows(spark.table(name).select("v"), "v") == [(10,), (22,)]


def test_a_table_can_be_corrected_from_itself(spark, database):
    name = f"{database}.itself"
    replace_partitions(days(spark, (1, 10), (2, 20)), name, "dt")
    replace_partitions(spark.table(name).where(F.col("dt") == day(2)).withColumn("v", -F.col("v")), name, "dt")
    assert rows(spark.table(name).select("v"), "v") == [(-20,), (10,)]


def test_two_loads_at_once(spark, database):
    from concurrent.futures import ThreadPoolExecutor

    name = f"{database}.together"
    replace_partitions(days(spark, *[(d, 0) for d in range(6)]), name, "dt")
    before = dict(spark.conf.getAll)
    with ThreadPoolExecutor(6) as pool:
        done = [
            pool.submit(replace_partitions, days(spark, (d, d + 1), (d, d + 100)), name, "dt", [day(d)])
            for d in range(6)
        ]
        seen = []
        while not all(f.done() for f in done):
            seen.append(dict(spark.conf.getAll) == before)
        for f in done:
            f.result()
    assert all(seen)
    assert rows(spark.table(name).select("v"), "v") == [(v,) for d in (1, 100) for v in range(d, d + 6)]


def test_partitioned_write_and_pruning(spark, database):
    name = f"{database}.partitioned"
    table = write_partitioned(days(spark, (1, 10), (2, 20), (2, 21)), name)
    assert latest_partition(spark, name) == day(2)
    newest = table.filter(F.col("dt") == F.lit(latest_partition(spark, name)))
    assert rows(newest.select("v"), "v") == [(20,), (21,)]
    text = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in text


def test_snapshot_of_a_table_reads_one_partition(spark, database):
    table = write_partitioned(days(spark, (1, 10), (2, 20), (3, 30)), f"{database}.snapshot")
    newest = latest_snapshot(table)
    assert rows(newest.select("v")) == [(30,)]
    text = newest._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[isnotnull\(dt#\d+\), \(dt#\d+ = Subquery", text)


def test_modes_load_and_copy(spark, database):
    name = f"{database}.loaded"
    texts = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, c string")
    schema = T.StructType([T.StructField("b", T.DoubleType()), T.StructField("a", T.LongType())])
    load(texts, name, schema)
    load(texts, name, schema)
    assert rows(spark.table(name)) == [(2.5, 1)]
    load(texts, name, schema, mode="append")
    assert spark.table(name).count() == 2
    copy_table(spark, name, f"{name}_copy")
    copy_table(spark, name, f"{name}_copy", overwrite=False)
    assert spark.table(f"{name}_copy").count() == 4
    with pytest.raises(ValueError):
        materialize(texts, name, mode="merge")


def test_copy_keeps_partitions(spark, database):
    name = f"{database}.dated"
    write_partitioned(days(spark, (1, 10), (2, 20)), name)
    copy_table(spark, name, f"{name}_copy")
    assert latest_partition(spark, f"{name}_copy") == day(2)


def test_copy_keeps_all_partition_columns(spark, database):
    name = f"{database}.by_two"
    df = days(spark, (1, 10), (2, 20)).withColumn("kind", F.lit("a"))
    df.write.partitionBy("dt", "kind").saveAsTable(name)
    copy_table(spark, name, f"{name}_copy")
    columns = spark.catalog.listColumns(f"{name}_copy")
    assert [c.name for c in columns if c.isPartition] == ["dt", "kind"]
    assert spark.table(f"{name}_copy").count() == 2


def test_export(spark, folder):
    df = spark.range(100).repartition(4).withColumn("s", F.lit('a "b"; c'))
    export_csv(df, f"{folder}/one", sep=";", files=1)
    export_csv(df, f"{folder}/many", header=False)
    export_csv(df, f"{folder}/json", fmt="json")
    parts = {n: [f for f in os.listdir(f"{folder}/{n}") if f.startswith("part-")] for n in ("one", "many")}
    assert len(parts["one"]) == 1 and len(parts["many"]) == 4
    back = spark.read.option("header", True).option("sep", ";").option("escape", '"').csv(f"{folder}/one")
    assert back.columns == ["id", "s"] and back.count() == 100
    assert back.filter(F.col("s") == 'a "b"; c').count() == 100
    assert spark.read.json(f"{folder}/json").count() == 100
    with pytest.raises(ValueError):
        export_csv(df, f"{folder}/x", fmt="xml")


def test_scratch_lies_in_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(base) and first != second


def test_blank_first_line_is_no_header(spark, folder):
    put(folder, "g/01-22-2020.csv", "\nProvince/State,Country/Region,Confirmed\nHubei,China,444\n")
    got = read_daily(spark, f"{folder}/g", GLOBAL_DAILY)
    assert rows(got.select("province_state", "confirmed")) == [("Hubei", 444)]


def test_truncated_file_leaves_the_loaded_day(spark, folder, database):
    head = "Province/State,Country/Region,Confirmed\n"
    for name in ("01-22-2020", "01-23-2020"):
        put(folder, f"g/{name}.csv", head + "Hubei,China,444\n")
    table = f"{database}.truncated"
    days = ("2020-01-22", "2020-01-23")
    ingest_daily_reports(spark, f"{folder}/g", table, GLOBAL_DAILY, *days)
    put(folder, "g/01-22-2020.csv", "")
    with pytest.raises(Exception, match="01-22-2020"):
        ingest_daily_reports(spark, f"{folder}/g", table, GLOBAL_DAILY, *days)
    assert spark.table(table).count() == 2


def test_row_with_too_many_fields(spark, folder):
    put(folder, "g/01-22-2020.csv", "Province/State,Country/Region,Confirmed\nA,B,1,99\nC,D,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_daily(spark, f"{folder}/g", GLOBAL_DAILY).select("province_state").collect()
    got = read_daily(spark, f"{folder}/g", GLOBAL_DAILY, mode="permissive")
    assert rows(got.select("province_state", "confirmed")) == [("A", 1), ("C", 2)]


def test_quoted_line_break_in_a_report(spark, folder):
    put(folder, "g/01-22-2020.csv", 'Province/State,Country/Region,Confirmed\n"A\nB",C,1\n')
    got = read_daily(spark, f"{folder}/g", GLOBAL_DAILY)
    assert rows(got.select("province_state", "confirmed")) == [("A\nB", 1)]


def test_quoted_line_break_in_a_wide_file(spark, folder):
    put(folder, "a.csv", f'{HEAD},1/22/20\n"two\nlines",A,1,2,3\n"x ""y"", z",B,1,2,4\n')
    put(folder, "b.csv", f"{HEAD},1/22/20\nplain,C,1,2,5\n")
    got = read_wide(spark, folder, GLOBAL_IDS).select("province_state", "dt_20200122")
    assert rows(got, "dt_20200122") == [("two\nlines", 3), ('x "y", z', 4), ("plain", 5)]


def test_headers_of_files(spark, folder):
    put(folder, "a.csv", '\n  \n\ufeff,"B, b","say ""x"""\n1,2,3\n')
    put(folder, "b [1]/part-0.csv", 'X\n"1\n2"\n')
    put(folder, "empty.csv", "")
    put(folder, "_hidden.csv", "H\n")
    found = {
        r.file_path.rsplit("/", 1)[-1]: (r.header, r.multi)
        for r in file_headers(spark, [folder]).collect()
    }
    assert found == {
        "a.csv": (["", "B, b", 'say "x"'], False),
        "part-0.csv": (["X"], True),
        "empty.csv": (None, False),
    }
    with pytest.raises(ValueError, match="1 files without a header, first .*empty.csv"):
        header_groups(file_headers(spark, [folder]))


def test_groups_of_headers_by_days_and_by_files(spark, folder):
    day = report_day()
    for name, head in (("01-01", "A,B"), ("01-02", "A,B"), ("01-03", "B,A"), ("01-04", "A,B")):
        put(folder, f"{name}-2021.csv", f"{head}\n1,2\n")
    heads = file_headers(spark, [folder])
    groups = header_groups(heads, day)
    assert [g.header for g in groups] == [("A", "B"), ("B", "A")]
    assert [len(g.days) for g in groups] == [3, 1]
    picked = [heads.where(g.files).count() for g in groups]
    assert picked == [3, 1]
    # Two kinds of parts in one day are told apart by their names.
    put(folder, "01-05-2021.csv/part-0.csv", "A,B\n1,2\n")
    put(folder, "01-05-2021.csv/part-1.csv", "B,A\n1,2\n")
    groups = header_groups(file_headers(spark, [folder]), day)
    assert [heads.where(g.files).count() for g in groups] == [3, 1]
    assert [file_headers(spark, [folder]).where(g.files).count() for g in groups] == [4, 2]


def test_reports_in_folders_of_years(spark, folder):
    put(folder, "2020/01-22-2020.csv", "Country_Region,Confirmed\nX,1\n")
    put(folder, "2021/01-22-2021.csv", "Confirmed,Country_Region\n2,X\n")
    put(folder, "2021/notes.csv", "Something\nelse\n")
    got = read_daily(spark, folder, GLOBAL_DAILY).select("report_dt", "confirmed")
    assert rows(got, "confirmed") == [(dt.date(2020, 1, 22), 1), (dt.date(2021, 1, 22), 2)]
    one = read_daily(spark, folder, GLOBAL_DAILY, days=["2021-01-22"])
    assert rows(one.select("confirmed")) == [(2,)]


def test_wanted_days_are_not_looked_for_elsewhere(spark, folder):
    put(folder, "01-22-2020.csv", "Country_Region,Confirmed\nX,1\n")
    put(folder, "deep/er/01-23-2020.csv", "Surprise\n1\n")
    got = read_daily(spark, folder, GLOBAL_DAILY, days=["2020-01-22"])
    assert got.count() == 1
    files = {p.rsplit("/", 1)[-1] for p in got.inputFiles()}
    assert files == {"01-22-2020.csv"}


def test_files_are_split_unless_a_field_holds_a_line_break(spark, folder):
    lines = "".join(f"X,{k}\n" for k in range(20000))
    put(folder, "a/01-22-2020.csv", "Country_Region,Confirmed\n" + lines)
    put(folder, "b/01-22-2020.csv", 'Country_Region,Confirmed\n"X\nY",7\n' + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        split = read_daily(spark, f"{folder}/a", GLOBAL_DAILY)
        whole = read_daily(spark, f"{folder}/b", GLOBAL_DAILY)
        assert split.rdd.getNumPartitions() > 3 and whole.rdd.getNumPartitions() == 1
        assert (split.count(), whole.count()) == (20000, 20001)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")

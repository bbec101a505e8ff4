import os
import time

import pytest
from helpers import rows

from casetrends.streaming import publish_stream, published
from casetrends.streaming.publish import text_schema

SCHEMA = text_schema(("dt", "county", "total"))
HEADER = "dt,county,total\n"


def put(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.write(text)


def run(spark, folder, **options):
    args = (f"{folder}/in", f"{folder}/out", f"{folder}/state")
    publish_stream(spark, *args, schema=SCHEMA, **options).awaitTermination()


def test_only_csv_and_replace_by_name(spark, folder):
    put(folder, "in/1/x.csv", HEADER + '2020-01-22,"A, b",1\n2020-01-22,B,2\n')
    put(folder, "in/1/y.txt", HEADER + "2020-01-22,C,3\n")
    put(folder, "in/1/z.csv", HEADER + "2020-01-22,D,4\n")
    run(spark, folder)
    assert rows(published(spark, f"{folder}/out"), "total") == [
        ("2020-01-22", "A, b", "1", "x"),
        ("2020-01-22", "B", "2", "x"),
        ("2020-01-22", "D", "4", "z"),
    ]
    put(folder, "in/2/x.csv", HEADER + "2020-01-23,A,9\n")
    run(spark, folder)
    assert rows(published(spark, f"{folder}/out", "x")) == [("2020-01-23", "A", "9")]
    assert published(spark, f"{folder}/out", "z").count() == 1


def test_newest_upload_of_a_batch_wins(spark, folder):
    put(folder, "in/new/x.csv", HEADER + "2020-01-23,A,9\n")
    put(folder, "in/old/x.csv", HEADER + "2020-01-22,A,1\n")
    now = time.time()
    os.utime(f"{folder}/in/old/x.csv", (now - 100, now - 100))
    run(spark, folder)
    assert rows(published(spark, f"{folder}/out", "x")) == [("2020-01-23", "A", "9")]


def test_header_only_file_empties_its_table(spark, folder):
    put(folder, "in/1/x.csv", HEADER + "2020-01-22,A,1\n")
    run(spark, folder)
    put(folder, "in/2/x.csv", HEADER)
    run(spark, folder)
    assert published(spark, f"{folder}/out", "x").count() == 0


def test_folder_uploads(spark, folder):
    for run_name, value in (("20200122", 1), ("20200123", 2)):
        for part in (0, 1):
            put(folder, f"in/us_cur/{run_name}/part-{part}.csv", HEADER + f"d,{part},{value}\n")
    run(spark, folder, name_from="folder")
    assert rows(published(spark, f"{folder}/out", "us_cur"), "county") == [("d", "0", "2"), ("d", "1", "2")]


def test_parts_of_two_batches_are_one_upload(spark, folder):
    put(folder, "in/x/20200122/part-0.csv", HEADER + "d,0,1\n")
    run(spark, folder, name_from="folder")
    put(folder, "in/x/20200122/part-1.csv", HEADER + "d,1,1\n")
    run(spark, folder, name_from="folder")
    assert rows(published(spark, f"{folder}/out", "x"), "county") == [("d", "0", "1"), ("d", "1", "1")]


def test_late_old_upload_does_not_replace_a_newer_one(spark, folder):
    put(folder, "in/x/20200123/part-0.csv", HEADER + "d,A,2\n")
    run(spark, folder, name_from="folder")
    put(folder, "in/x/20200122/part-0.csv", HEADER + "d,A,1\n")
    run(spark, folder, name_from="folder")
    assert rows(published(spark, f"{folder}/out", "x")) == [("d", "A", "2")]
    # Also where the newer one is not below the folder.
    put(folder, "other/x/20200122/part-0.csv", HEADER + "d,A,1\n")
    publish_stream(
        spark, f"{folder}/other", f"{folder}/out", f"{folder}/other-state", SCHEMA, "folder"
    ).awaitTermination()
    assert rows(published(spark, f"{folder}/out", "x")) == [("d", "A", "2")]


def test_empty_object_empties_its_table(spark, folder):
    put(folder, "in/1/x.csv", HEADER + "2020-01-22,A,1\n")
    put(folder, "in/1/y [1],{2}.csv", HEADER + "2020-01-22,A,1\n")
    run(spark, folder)
    put(folder, "in/2/x.csv", "")
    run(spark, folder)
    assert rows(published(spark, f"{folder}/out")) == [("2020-01-22", "A", "1", "y [1],{2}")]


def test_only_marked_folders(spark, folder):
    options = {"name_from": "folder", "marker": "_SUCCESS"}
    put(folder, "in/x/20200122/part-0.csv", HEADER + "d,A,1\n")
    put(folder, "in/x/20200122/_SUCCESS", "")
    put(folder, "in/x/20200123/part-0.csv", HEADER + "d,A,2\n")
    run(spark, folder, **options)
    assert rows(published(spark, f"{folder}/out", "x")) == [("d", "A", "1")]
    put(folder, "in/x/20200123/_SUCCESS", "")
    run(spark, folder, **options)
    assert rows(published(spark, f"{folder}/out", "x")) == [("d", "A", "2")]


def test_wrong_header_fails(spark, folder):
    put(folder, "in/1/x.csv", "dt,total,county\n2020-01-22,1,A\n")
    with pytest.raises(Exception, match="without the header"):
        run(spark, folder)


def test_names_with_spaces(spark, folder):
    put(folder, "in/1/us current.csv", HEADER + "2020-01-22,A,1\n")
    run(spark, folder)
    assert published(spark, f"{folder}/out", "us current").count() == 1


def test_options(spark, folder):
    with pytest.raises(ValueError):
        run(spark, folder, name_from="sheet")


def test_quoted_line_break(spark, folder):
    put(folder, "in/1/x.csv", HEADER + '2020-01-22,"two\nlines, ""q""",1\n2020-01-22,B,2\n')
    run(spark, folder)
    assert rows(published(spark, f"{folder}/out", "x"), "total") == [
        ("2020-01-22", 'two\nlines, "q"', "1"), ("2020-01-22", "B", "2")
    ]


def test_work_follows_arrivals_not_history(spark, folder, monkeypatch):
    from casetrends.streaming import publish

    for k in range(1000):
        put(folder, f"in/old{k % 50}/{k:04}/part-0.csv", HEADER + f"d,A,{k}\n")
    run(spark, folder, name_from="folder")
    assert published(spark, f"{folder}/out").count() == 50
    looked_at = []
    parts = publish._parts
    monkeypatch.setattr(publish, "_parts", lambda s, f: looked_at.append(f) or parts(s, f))
    versions = publish._published_versions
    monkeypatch.setattr(
        publish, "_published_versions", lambda s, o, names: looked_at.append(names) or versions(s, o, names)
    )
    put(folder, "in/old7/2000/part-0.csv", HEADER + "d,A,new\n")
    run(spark, folder, name_from="folder")
    assert [x if isinstance(x, set) else x[-9:] for x in looked_at] == [{"old7"}, "old7/2000"]
    assert rows(published(spark, f"{folder}/out", "old7")) == [("d", "A", "new")]
    assert published(spark, f"{folder}/out").count() == 50
    # Nothing has arrived: nothing is looked at.
    looked_at.clear()
    run(spark, folder, name_from="folder")
    assert looked_at == []


def test_lost_ledger_gives_the_same_tables(spark, folder):
    """As after a failure between the tables and the ledger."""
    import shutil

    put(folder, "in/x/1/part-0.csv", HEADER + "d,A,1\n")
    put(folder, "in/x/2/part-0.csv", HEADER + "d,A,2\n")
    run(spark, folder, name_from="folder")
    shutil.rmtree(f"{folder}/state/ledger")
    put(folder, "in/y/1/part-0.csv", HEADER + "d,B,3\n")
    run(spark, folder, name_from="folder")
    assert rows(published(spark, f"{folder}/out"), "target") == [("d", "A", "2", "x"), ("d", "B", "3", "y")]


def test_superseded_upload_without_marker_is_dealt_with(spark, folder):
    options = {"name_from": "folder", "marker": "_SUCCESS"}
    put(folder, "in/x/1/part-0.csv", HEADER + "d,A,1\n")
    run(spark, folder, **options)
    put(folder, "in/x/2/part-0.csv", HEADER + "d,A,2\n")
    put(folder, "in/x/2/_SUCCESS", "")
    run(spark, folder, **options)
    assert rows(published(spark, f"{folder}/out", "x")) == [("d", "A", "2")]
    put(folder, "in/x/1/_SUCCESS", "")
    run(spark, folder, **options)
    assert rows(published(spark, f"{folder}/out", "x")) == [("d", "A", "2")]
    assert spark.read.parquet(f"{folder}/state/ledger").distinct().count() == 2

"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

``python tests/oracle.py /root/testdata/sf0.01 [name ...]`` prints one line per query.
"""

import datetime as dt
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB type -> Spark types that hold the same values.
SAME_TYPE = {
    "BIGINT": {"bigint"},
    "INTEGER": {"int"},
    "DOUBLE": {"double"},
    "VARCHAR": {"string"},
    "DATE": {"date"},
    "TIMESTAMP": {"timestamp_ntz"},
    "BOOLEAN": {"boolean"},
}


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float):
        return 0.0 if value == 0 and str(value) != "-0.0" else value
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def compare(spark, con, name, fn, sql, sf) -> list[str]:
    """Differences between the two results; empty when they are equal."""
    df = fn(spark, sf)
    columns = sorted(df.columns)
    got = sorted(
        (tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=_key
    )
    relation = con.sql(sql)
    problems = []
    if sorted(relation.columns) != columns:
        return [f"columns {columns} / {sorted(relation.columns)}"]
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    for c, t in df.dtypes:
        if t not in SAME_TYPE.get(theirs[c], ()):
            problems.append(f"type of {c}: {t} / {theirs[c]}")
    picked = ", ".join(f'"{c}"' for c in columns)
    want = sorted(
        (tuple(_plain(v) for v in r) for r in con.sql(f"SELECT {picked} FROM ({sql})").fetchall()),
        key=_key,
    )
    if len(got) != len(want):
        problems.append(f"rows {len(got)} / {len(want)}")
    differing = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if differing:
        problems.append(f"{len(differing)} rows differ, first {differing[0]}")
    if not got:
        problems.append("no rows")
    return problems


def main(sf, *names):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    from querybook import ORACLE, QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), 0
    for name, fn in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            problems = compare(spark, con, name, fn, ORACLE[name], sf)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{time.time() - started:6.2f}s {name}: {'; '.join(problems) or 'ok'}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main(*sys.argv[1:])

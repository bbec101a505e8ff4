"""Catalog tables: typed loads, partitioned writes, partition replacement and copies."""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.functions.dates import Day, as_day
from casetrends.operators.project import quoted

MODES = ("overwrite", "append")


def _writer(df: DataFrame, mode: str, partition_by: str | list[str] | None) -> DataFrameWriter:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    columns = [partition_by] if isinstance(partition_by, str) else partition_by
    if not columns:
        return df.write.format("parquet").mode(mode)
    return spread(df, *columns).write.format("parquet").mode(mode).partitionBy(*columns)


def spread(df: DataFrame, *partition_by: str) -> DataFrame:
    """Bring the rows of a table partition together without a limit on its size.

    A rebalance, not ``repartition``: adaptive execution merges small days into one task and
    cuts a large day into files of the advisory size.
    """
    return df.hint("rebalance", *[F.col(quoted(c)) for c in partition_by])


def load(
    df: DataFrame,
    table: str,
    schema: T.StructType,
    mode: str = "overwrite",
    partition_by: str | None = None,
) -> None:
    """Write the columns of ``schema``, cast to its types, to ``table``."""
    cast = df.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    _writer(cast, mode, partition_by).saveAsTable(table)


def materialize(
    df: DataFrame, table: str, mode: str = "overwrite", partition_by: str | None = None
) -> DataFrame:
    """Run a query into a table and return the table in the query's column order.

    The catalog itself lists a partition column last.
    """
    _writer(df, mode, partition_by).saveAsTable(table)
    return df.sparkSession.table(table).select(*[F.col(quoted(c)) for c in df.columns])


def write_partitioned(
    df: DataFrame, table: str, partition_by: str = "dt", mode: str = "overwrite"
) -> DataFrame:
    """A table with one partition per day of ``partition_by``."""
    return materialize(df, table, mode, partition_by)


def replace_partitions(
    df: DataFrame,
    table: str,
    partition_by: str = "report_dt",
    days: list[Day] | None = None,
    since: Day | None = None,
) -> None:
    """Replace the days that ``df`` holds; other days of the table stay as they are.

    Running it twice leaves the same table. ``days`` names the days meant to be replaced: rows of
    another day are an error, and a named day without rows ends up empty. ``since`` means all days
    from that one on. Rows without a day are an error.

    The rows are computed once, into a folder of the load inside the table's own. What the load
    holds is read off its folders; only then each day is pointed to its new files, one day
    at a time, and the old files go. Until then, and where the load fails, the table is as it was.
    No setting of the session is touched, and ``df`` may read the table itself.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        empty = spark.createDataFrame([], df.schema)
        _writer(empty, "append", partition_by).saveAsTable(table)
    fields = [f for f in spark.table(table).schema.fields]
    home = _location(spark, f"DESCRIBE TABLE EXTENDED {table}")
    load = f"{home}/_load-{uuid.uuid4().hex}"
    typed = df.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in fields])
    spread(typed, partition_by).write.partitionBy(partition_by).parquet(load)
    try:
        staged = _staged_days(spark, load, partition_by)
        if None in staged:
            raise ValueError(f"{table}: rows without a day")
        present = _partition_days(spark, table, partition_by)
        wanted = set(staged) if days is None else {as_day(d) for d in days}
        if since is not None:
            first = as_day(since)
            wanted = {d for d in wanted | present if d >= first}
        if stray := sorted(set(staged) - wanted):
            raise ValueError(f"{table}: row of an unnamed day: {', '.join(map(str, stray))}")
    except ValueError:
        _delete(spark, load)
        raise

    def partition(day: dt.date) -> str:
        return f"PARTITION ({quoted(partition_by)} = DATE '{day}')"

    if new := sorted(set(staged) - present):
        places = " ".join(f"{partition(d)} LOCATION '{staged[d]}'" for d in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {places}")
    for day in sorted(set(staged) & present):
        old = _location(spark, f"DESCRIBE TABLE EXTENDED {table} {partition(day)}")
        spark.sql(f"ALTER TABLE {table} {partition(day)} SET LOCATION '{staged[day]}'")
        if old.startswith(home):
            _delete(spark, old)
    if gone := sorted((wanted & present) - set(staged)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(map(partition, gone))}")
    spark.catalog.refreshTable(table)


def _location(spark: SparkSession, describe: str) -> str:
    """The location that a description of a table or partition names."""
    found = [r["data_type"] for r in spark.sql(describe).collect() if r["col_name"] == "Location"]
    return found[0].rstrip("/")


def _file_system(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _delete(spark: SparkSession, path: str) -> None:
    found, system = _file_system(spark, path)
    system.delete(found, True)


def _staged_days(spark: SparkSession, load: str, partition_by: str) -> dict[dt.date | None, str]:
    """The days of a load and their folders, from the folders' names."""
    found, system = _file_system(spark, load)
    out = {}
    for folder in system.listStatus(found):
        name, _, value = folder.getPath().getName().partition("=")
        if unquote(name) == partition_by:
            day = None if value == "__HIVE_DEFAULT_PARTITION__" else as_day(value)
            out[day] = f"{load}/{folder.getPath().getName()}"
    return out


def _partition_days(spark: SparkSession, table: str, partition_by: str) -> set[dt.date]:
    prefix = f"{partition_by}="
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    values = [part for r in rows for part in r[0].split("/") if part.startswith(prefix)]
    return {as_day(v.removeprefix(prefix)) for v in values if not v.endswith("__HIVE_DEFAULT_PARTITION__")}


def latest_partition(spark: SparkSession, table: str, partition_by: str = "dt") -> dt.date | None:
    """The newest day of a partitioned table from the catalog, without reading data."""
    return max(_partition_days(spark, table, partition_by), default=None)


def partition_date(column: str = "report_dt", alias: str = "dt") -> Column:
    """The load day as a date column; a filter on it prunes partitions."""
    return F.col(column).cast("date").alias(alias)


def copy_table(spark: SparkSession, source: str, destination: str, overwrite: bool = True) -> None:
    """Copy rows, columns and partitioning of ``source``, whichever columns partition it."""
    columns = [c.name for c in spark.catalog.listColumns(source) if c.isPartition]
    mode = "overwrite" if overwrite else "append"
    _writer(spark.table(source), mode, columns).saveAsTable(destination)

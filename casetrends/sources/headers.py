"""The headers of CSV files, found by tasks: the driver sees each distinct header once."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = "﻿"

Header = tuple[str, ...]

FILE = "_metadata.file_path"


def listed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_path`` of all data files below the paths, empty ones too; nothing is read."""
    tree = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    jvm = spark._jvm
    names = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(tree._jdf.inputFiles())
    made = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING())
    # A scan writes a path without a host as file:/..., this listing as file:///...
    path = F.regexp_replace("value", "^([^:/]+):///", "$1:/")
    return DataFrame(made.toDF(), spark).toDF("value").select(path.alias("file_path"))


def split_header(line: Column, sep: str = ",") -> Column:
    """The names in a header line; quoted ones may hold the separator and doubled quotes."""
    one = re.escape(sep)
    fields = F.regexp_extract_all(
        F.concat(F.lit(sep), line), F.lit(f'{one}("(?:[^"]|"")*"|[^{one}]*)'), F.lit(1)
    )
    return F.transform(
        fields,
        lambda f: F.when(
            f.startswith('"') & (F.length(f) > 1),
            F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )


def file_headers(
    spark: SparkSession, paths: list[str], sep: str = ",", keep: Column | None = None
) -> DataFrame:
    """``file_path, header, multi`` of the data files below the paths, made by one text scan.

    ``header`` is the first line that is not blank, split into names, without a byte order mark; NULL
    where a file has none. ``multi`` says that a quoted field of the file may hold a line
    break: some line has an odd number of quotes. A header itself is one line. ``keep`` is a
    condition on ``file_path``; other files are not read.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths).select(
        F.col(FILE).alias("file_path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.regexp_replace("value", f"^{BOM}", "").alias("line"),
        F.monotonically_increasing_id().alias("at"),
    )
    listed = listed_files(spark, paths)
    if keep is not None:
        lines, listed = lines.where(keep), listed.where(keep)
    first = (F.col("start") == 0) & (F.trim("line") != "")
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    found = lines.groupBy("file_path").agg(
        F.min(F.when(first, F.struct("at", "line"))).alias("head"),
        F.coalesce(F.bool_or(quotes % 2 == 1), F.lit(False)).alias("multi"),
    )
    return listed.join(found, "file_path", "left").select(
        "file_path", split_header(F.col("head.line"), sep).alias("header"),
        F.coalesce("multi", F.lit(False)).alias("multi"),
    )


@dataclass(frozen=True)
class HeaderGroup:
    """Files with one header, to be read by one scan: those that ``files`` is true for."""

    header: Header
    multi: bool
    example: str
    days: frozenset[dt.date]
    files: Column | None


def _ranges_are_apart(groups: list[frozenset[dt.date]]) -> bool:
    ranges = sorted((min(days), max(days)) for days in groups)
    return all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def header_groups(heads: DataFrame, day: Column | None = None) -> list[HeaderGroup]:
    """The distinct headers, and what picks the files of each.

    ``day`` is the date of a file, out of ``file_path``. Headers drift over time, so that a range of
    days, or else the days themselves, pick a header's files; the scan's own listing applies
    that. File names come to the driver only where a day has files of two kinds, or files
    have no day and differ.
    """
    day = F.lit(None).cast("date") if day is None else day
    found = (
        heads.groupBy("header", "multi")
        .agg(F.min("file_path").alias("example"), F.count(F.lit(1)).alias("n"),
             F.collect_set(day).alias("days"))
        .collect()
    )
    headless = [r for r in found if r["header"] is None]
    if headless:
        raise ValueError(
            f"{sum(r['n'] for r in headless)} files without a header, first {headless[0]['example']}"
        )
    days = [frozenset(r["days"]) for r in found]
    paths: dict[tuple, list[str]] = {}
    dated = all(days) and sum(map(len, days)) == len(frozenset().union(*days))
    if len(found) > 1 and not dated:
        paths = {
            (tuple(r["header"]), r["multi"]): r["paths"]
            for r in heads.groupBy("header", "multi").agg(F.collect_list("file_path").alias("paths")).collect()
        }
    own_day = F.col("file_path") if not dated else day
    groups = []
    for r, own in zip(found, days):
        key = (tuple(r["header"]), r["multi"])
        if len(found) == 1:
            files = None
        elif not dated:
            files = own_day.isin(paths[key])
        elif _ranges_are_apart(days):
            files = own_day.between(F.lit(min(own)), F.lit(max(own)))
        else:
            files = own_day.isin([F.lit(d) for d in sorted(own)])
        groups.append(HeaderGroup(key[0], key[1], r["example"], own, files))
    return sorted(groups, key=lambda g: g.example)

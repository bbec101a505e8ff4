"""Publishing CSV files as they arrive: each file replaces the table it is named after."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from casetrends.functions.names import strip_suffix
from casetrends.operators.project import quoted
from casetrends.schemas import US_SERIES_COLUMNS
from casetrends.sources.files import exact
from casetrends.sources.headers import listed_files
from casetrends.sources.tables import spread

SUFFIX = ".csv"
NAME_FROM = ("file", "folder")
VERSION = "_version"


def text_schema(columns: tuple[str, ...] = US_SERIES_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _decoded(uri: str) -> Column:
    """A file name out of its URI, where a plus sign is not a blank."""
    return F.url_decode(F.replace(F.col(uri), F.lit("+"), F.lit("%2B")))


def _target_and_version(
    in_dir: str, name_from: str, path: Column, millis: Column
) -> tuple[Column, Column]:
    """The published name of a file, and a text that sorts the uploads of a name by age."""
    if name_from == "file":
        age = F.lpad(millis.cast("string"), 20, "0")
        return strip_suffix(F.regexp_extract(path, "[^/]+$", 0), SUFFIX), F.concat_ws(" ", age, path)
    # <in_dir>/<name>/<run>/part-*.csv, or name=<name>/run=<run>: the greatest run is the newest.
    inside = re.escape(in_dir.rstrip("/").split(":")[-1].lstrip("/"))
    name = F.regexp_extract(path, inside + r"/(?:[^/=]+=)?([^/]+)/[^/]+/[^/]+$", 1)
    run = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return strip_suffix(name, SUFFIX), run


LEDGER = "path string"


def _arrivals(
    spark: SparkSession, in_dir: str, ledger: str, name_from: str
) -> list[tuple[str, str, str]]:
    """``(target, version, path)`` of the files below a folder that the ledger does not have yet,
    also of the empty ones that readers skip.

    Spark lists and compares; only what has arrived since comes to the driver and is asked for
    its age.
    """
    listed = listed_files(spark, [in_dir]).where(F.col("file_path").endswith(SUFFIX))
    if _exists(spark, ledger):
        handled = spark.read.schema(LEDGER).parquet(ledger)
        listed = listed.join(handled, F.col("file_path") == F.col("path"), "left_anti")
    paths = [r[0] for r in listed.select(_decoded("file_path")).collect()]
    millis = _millis(spark, paths) if name_from == "file" else [0] * len(paths)
    if not paths:
        return []
    files = spark.createDataFrame(list(zip(paths, millis)), "path string, millis long")
    target, version = _target_and_version(in_dir, name_from, F.col("path"), F.col("millis"))
    return [tuple(r) for r in files.select(target, version, "path").collect()]


def _millis(spark: SparkSession, paths: list[str]) -> list[int]:
    system = spark._jsparkSession.sessionState().newHadoopConf()
    found = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return [p.getFileSystem(system).getFileStatus(p).getModificationTime() for p in found]


def _parts(spark: SparkSession, folder: str) -> list[str]:
    """The data files of one upload folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [f.getPath().toString() for f in system.listStatus(path)]
    return [n for n in names if n.endswith(SUFFIX) and n.rsplit("/", 1)[-1][0] not in "._"]


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(found)


def _published_versions(spark: SparkSession, out_dir: str, names: set[str]) -> dict[str, str]:
    """The published version of these tables; tables written before there were any are left out."""
    if not _exists(spark, out_dir):
        return {}
    wanted = spark.createDataFrame([(n,) for n in sorted(names)], "target string")
    stored = spark.read.schema(f"`{VERSION}` string, target string").parquet(out_dir)
    own = stored.filter(F.col(VERSION).isNotNull()).join(wanted, "target", "left_semi")
    return {r[0]: r[1] for r in own.groupBy("target").agg(F.max(VERSION)).collect()}


def publish_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    schema: T.StructType | None = None,
    name_from: str = "file",
    marker: str | None = None,
) -> StreamingQuery:
    """Publish every ``*.csv`` that has arrived below ``in_dir`` and stop.

    ``<name>.csv`` replaces the whole published ``<name>``; other files are ignored. The file
    source remembers paths, so a name is published again by writing it to a new folder. With
    ``name_from="folder"`` an upload is a folder of part files, ``<name>/<run>/part-*.csv``,
    and its run folders sort by age (a time stamp as the name does). With a ``marker`` (such as
    ``_SUCCESS``) only folders that hold a file of that name are published; one that gets it
    later is published by the next call.

    A batch only tells that files have arrived. A ledger in ``checkpoint`` has the files that were
    dealt with; what is below ``in_dir`` and not in it has arrived. For each name among these the
    newest upload is read whole, in whatever batches its parts came, unless a newer one is
    published; names without arrivals are not looked at, whatever their history. An upload that still
    lacks its marker stays out of the ledger.

    Each batch is one dynamic partition overwrite, and the ledger is written after it, so repeating
    a batch after a failure leaves the same tables. Quoted fields may hold line breaks. Header rows stay in the stored data (``is_header``), and each table has a row
    with its version among them; a file that is empty or has only a header therefore empties its
    table.
    """
    if name_from not in NAME_FROM:
        raise ValueError(f"name_from must be one of {NAME_FROM}, not {name_from!r}")
    if marker is not None and name_from != "folder":
        raise ValueError("a marker needs name_from='folder'")
    schema = schema or text_schema()
    millis = F.unix_millis(F.col("_metadata.file_modification_time"))
    target, _ = _target_and_version(in_dir, name_from, _decoded("_metadata.file_path"), millis)
    header_row = F.lit(True)
    for name in schema.names:
        header_row = header_row & F.col(quoted(name)).eqNullSafe(F.lit(name))

    ledger = f"{checkpoint.rstrip('/')}/ledger"

    def publish() -> None:
        arrived = _arrivals(spark, in_dir, ledger, name_from)
        if not arrived:
            return
        uploads: dict[str, dict[str, list[str]]] = {}
        for name, version, path in arrived:
            uploads.setdefault(name, {}).setdefault(version, []).append(path)
        before = _published_versions(spark, out_dir, set(uploads))
        kept: list[tuple[str, str, str]] = []
        waiting: set[str] = set()
        for name, versions in uploads.items():
            for version in sorted(versions, reverse=True):
                if version < before.get(name, ""):
                    break
                paths = versions[version]
                if name_from == "folder":
                    folder = paths[0].rsplit("/", 1)[0]
                    if marker is not None and not _exists(spark, f"{folder}/{marker}"):
                        waiting.update(paths)
                        continue
                    # Parts of it may have been published before.
                    paths = _parts(spark, folder)
                kept += [(name, version, path) for path in paths]
                break
        if kept:
            replace_tables(kept)
        done = [(path,) for _, _, path in arrived if path not in waiting]
        if done:
            # The ledger has paths as listings write them, so it is filled from one.
            handled = spark.createDataFrame(done, LEDGER)
            listing = listed_files(spark, [in_dir]).withColumn("path", _decoded("file_path"))
            listing.join(handled, "path", "left_semi").select(F.col("file_path").alias("path")).write.mode(
                "append"
            ).parquet(ledger)

    def replace_tables(kept: list[tuple[str, str, str]]) -> None:
        read = (
            spark.read.schema(schema)
            .option("header", False)
            .option("multiLine", True)
            .option("escape", '"')
            .csv([exact(path) for _, _, path in kept])
            .select(
                *[quoted(c) for c in schema.names],
                header_row.alias("is_header"),
                F.lit(None).cast("string").alias(VERSION),
                F.col("_metadata.file_path").alias("file_path"),
                target.alias("target"),
            )
        )
        by_file = read.groupBy("file_path").agg(F.bool_or("is_header").alias("has_header"))
        headless = [r.file_path for r in by_file.filter(~F.col("has_header")).limit(20).collect()]
        if headless:
            raise ValueError(f"files without the header {schema.names}: {headless}")
        own = spark.createDataFrame(
            sorted({(name, version) for name, version, _ in kept}), "target string, version string"
        ).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
            F.lit(True).alias("is_header"), F.col("version").alias(VERSION), "target",
        )
        (
            spread(read.drop("file_path").unionByName(own), "target")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("target")
            .parquet(out_dir)
        )

    if marker is not None and _exists(spark, in_dir):
        publish()
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "*" + SUFFIX)
        .option("recursiveFileLookup", True)
        .csv(in_dir)
        .writeStream.foreachBatch(lambda batch, _: publish())
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def published(spark: SparkSession, out_dir: str, target: str | None = None) -> DataFrame:
    """The data rows of one published table, or of all with their ``target``."""
    rows = spark.read.parquet(out_dir).filter(~F.col("is_header")).drop("is_header", VERSION)
    if target is None:
        return rows
    return rows.filter(F.col("target") == target).drop("target")

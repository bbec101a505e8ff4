"""CSV scans and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.sources.headers import FILE, HeaderGroup


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder that ``spark.checkpoint.dir`` names.

    Where the setting is absent, a local session gets a temporary folder; on a cluster that is
    an error, as executors would not share one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/casetrends-{name}-{uuid.uuid4().hex[:12]}"


def exact(path: str) -> str:
    """The path as a pattern that only it matches."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def read_text_csv(
    spark: SparkSession,
    paths: list[str],
    group: HeaderGroup,
    sep: str = ",",
    counts_from: int | None = None,
    mode: str = "PERMISSIVE",
    keep: Column | None = None,
    whole_rows: bool = False,
    corrupt: str | None = None,
) -> DataFrame:
    """The CSV files of a group as strings, with ``file_path``; columns from ``counts_from`` on as
    BIGINT. ``corrupt`` names one more column for the text of rows that don't fit.

    The CSV reader assigns values by position, so the header of each file is checked against
    the names (``enforceSchema=false``) and a file with another column order fails the job. Files
    are split among tasks unless the group has quoted line breaks. With ``whole_rows`` each row is
    parsed and checked whatever columns are read. ``keep`` is a condition on ``file_path``.
    """
    texts = len(group.header) if counts_from is None else counts_from
    schema = T.StructType(
        [
            T.StructField(name, T.StringType() if i < texts else T.LongType())
            for i, name in enumerate(group.header)
        ]
    )
    if corrupt is not None:
        schema.add(corrupt, T.StringType())
    rows = (
        spark.read.schema(schema)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", corrupt or "_corrupt_record")
        .option("header", True)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("multiLine", group.multi)
        .option("columnPruning", not whole_rows)
        .option("sep", sep)
        .option("escape", '"')
        .csv(paths)
        .select("*", F.col(FILE).alias("file_path"))
    )
    for condition in (keep, group.files):
        if condition is not None:
            rows = rows.where(condition)
    return rows

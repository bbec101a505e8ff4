"""Exports of tables as delimited text and other file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("csv", "json", "parquet", "orc")


def export_csv(
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    fmt: str = "csv",
    files: int | None = None,
) -> None:
    """Write ``df`` to the folder ``path``.

    ``files`` is the number of files, for results that are small by contract; None keeps the
    partitions.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, not {fmt!r}")
    if files is not None:
        df = df.repartition(files)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("sep", sep).option("header", header).option("escape", '"')
    writer.save(path)


def export_table(spark: SparkSession, table: str, path: str, **options) -> None:
    export_csv(spark.table(table), path, **options)

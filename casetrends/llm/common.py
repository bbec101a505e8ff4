"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything in ASCII that is neither a digit nor a small letter separates words.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores put before it as make it new to ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """The column of that very name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text; empty where it is NULL."""
    return F.coalesce(col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; ASCII texts take the short way."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def word_text(text: Column) -> Column:
    """The lower-cased words of a text with one space between them."""
    return F.trim(F.regexp_replace(lower_ascii(text), NOT_WORD, " "))


def word_array(text: Column) -> Column:
    """The lower-cased words of a text; an empty array where there is none."""
    plain = word_text(text)
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of id and text as ``k1``, ``k2``. Rows that repeat both share the key."""
    name = F.coalesce(F.concat(F.lit("="), col(id_col).cast("string")), F.lit("null"))
    text = text_of(text_col)
    return [
        F.xxhash64(name, text).alias("k1"),
        F.xxhash64(F.lit(1), name, text).alias("k2"),
    ]


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one takes a temporary one."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Compute the frame once and store it in the shared folder of ``spark.checkpoint.dir``.

    Only where that setting is absent, as in tests, a folder is chosen here.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """Inside, each query's shuffle files are removed when it has ended, as its result is stored.

    The setting changes no result; it is put back at the end.
    """
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def tidy_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings that removes a query's shuffle files when it has ended.

    For rounds that each end in a table. The caller's session stays as it is.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(CLEAN_UP, "true")
    return own

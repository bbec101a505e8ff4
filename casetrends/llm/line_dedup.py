"""Lines that several documents hold, kept in the first of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.llm.common import WHITE, col, cut, lower_ascii, row_key, text_of, unused


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case."""
    return lower_ascii(F.btrim(line, F.lit(WHITE)))


def dropped_lines(
    docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int
) -> DataFrame:
    """``k1, k2, drops``: by document, the positions of the lines it loses."""
    lines = (
        docs.select(
            col(id_col).alias("id"),
            *row_key(id_col, text_col),
            F.posexplode(F.split(text_of(text_col), "\n")).alias("pos", "line"),
        )
        .where(F.col("id").isNotNull())
        .select("id", "k1", "k2", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(
            "id", "k1", "k2", "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
        )
    )
    # A line in a third of all documents makes one large key on the left of the join below. With
    # the shared lines stored, both of its sides are plain shuffles, and adaptive execution splits
    # that key; the right side has one row for it.
    shared = cut(
        lines.groupBy("h1", "h2")
        .agg(F.countDistinct("id").alias("n"), F.min("id").alias("owner"))
        .where(F.col("n") >= min_docs)
        .drop("n")
    )
    return (
        lines.join(shared, ["h1", "h2"])
        .where(F.col("id") != F.col("owner"))
        .groupBy("k1", "k2")
        .agg(F.collect_set("pos").alias("drops"))
    )


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 2,
    min_chars: int = 10,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The documents without repeated lines.

    A line whose key has ``min_chars`` code points or more and is found in ``min_docs`` documents
    or more stays only in the smallest id that holds it, there as often as it occurs. Other lines
    stay in their order. All columns come back, the text replaced, with the two counts under the
    names in ``counts`` (a column of that name is replaced; None adds none).

    NULL text is one empty line, and its result is the empty text. A row without id takes no
    part: it loses nothing and counts for no line. Rows with one id are one document, even if
    their texts differ; repeated rows all come back. An empty table gives an empty table.
    """
    drops_of = dropped_lines(docs, id_col, text_col, min_docs, min_chars)
    a, b, drops, lines = unused(docs, "k1", "k2", "drops", "lines")
    k1, k2 = row_key(id_col, text_col)
    joined = docs.withColumns({a: k1, b: k2}).join(
        drops_of.select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("drops").alias(drops)),
        [a, b],
        "left",
    )
    split = joined.withColumn(lines, F.split(text_of(text_col), "\n"))
    count, lost = F.size(lines), F.coalesce(F.size(drops), F.lit(0))
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), count - 1), col(drops)),
        lambda i: F.element_at(col(lines), i + 1),
    )
    text = F.when(lost > 0, F.array_join(kept, "\n")).otherwise(text_of(text_col))
    named = dict(zip(counts or (), (count.cast("long"), lost.cast("long"))))
    out = [c for c in docs.columns if c not in named]
    return split.select(
        *[text.alias(c) if c == text_col else col(c) for c in out],
        *[c.alias(name) for name, c in named.items()],
    )

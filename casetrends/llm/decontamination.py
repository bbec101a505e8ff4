"""Documents that repeat word windows of benchmark items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.llm.common import (
    col,
    row_key,
    text_of,
    unused,
    word_array,
)

# A word of a text whose case is as it was.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Windows up to which the benchmark's side is broadcast: some 100 bytes each, 100 MB in all.
BROADCAST_WINDOWS = 1_000_000


def item_windows(
    benchmark: DataFrame, id_col: str, text_col: str, window: int
) -> DataFrame:
    """``len, grams, items``: each distinct window of the items, with the items that hold it.

    An item of fewer words than ``window`` is one window of its own length.
    """
    words = benchmark.select(
        col(id_col).alias("item"), word_array(text_of(text_col)).alias("words")
    ).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    return (
        words.withColumn("len", length)
        .withColumn("start", F.explode(starts))
        .select("item", "len", F.array_join(F.slice("words", F.col("start"), F.col("len")), " ")
                .alias("gram"))
        .groupBy("len", "gram")
        .agg(F.collect_set("item").alias("items"))
    )


def _block(length: int) -> int:
    """Words in a block such that any window of ``length`` words holds a whole aligned one."""
    return (length + 1) // 2


def _bounded(df: DataFrame, bounded: bool) -> DataFrame:
    return F.broadcast(df) if bounded else df


def _blocks(length: int) -> Column:
    """``(len, at, block, around)`` for every aligned block of ``words``.

    ``around`` is the text of all windows that hold the block.
    """
    k = _block(length)
    reach = length - k

    def block(b: Column) -> Column:
        at = b * k
        low = F.greatest(at - reach, F.lit(0))
        return F.struct(
            F.lit(length).alias("len"),
            at.alias("at"),
            F.xxhash64(F.lit(length), F.array_join(F.slice("words", at + 1, F.lit(k)), " "))
            .alias("block"),
            F.array_join(F.slice("words", low + 1, at - low + k + reach), " ").alias("around"),
        )

    n = F.floor(F.size("words") / k).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), block)).otherwise(
        F.array().cast("array<struct<len:int,at:int,block:bigint,around:string>>")
    )


def _windows() -> Column:
    """``(start, gram)`` for the windows of a hit block; one NULL pair for a document's own row."""
    around = F.split("around", " ")
    k = F.floor((F.col("len") + 1) / 2).cast("int")
    low = F.greatest(F.col("at") - (F.col("len") - k), F.lit(0))
    high = F.least(F.col("at"), F.col("n_words") - F.col("len"))
    whole = F.transform(
        F.sequence(low, high),
        lambda s: F.struct(
            s.alias("start"),
            F.array_join(F.slice(around, s - low + 1, F.col("len")), " ").alias("gram"),
        ),
    )
    kind = "array<struct<start:int,gram:string>>"
    none = F.array(F.struct(F.lit(None).cast("int").alias("start"),
                            F.lit(None).cast("string").alias("gram")))
    return (
        F.when(F.col("len").isNull(), none.cast(kind))
        .when(high >= low, whole)
        .otherwise(F.array().cast(kind))
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 13,
) -> DataFrame:
    """``k1, k2, id, n_rows, n_words, spans, items``: what each document repeats of the items.

    Words are lower-cased runs of digits, letters and whatever is not ASCII. ``spans`` are the
    word ranges ``(start, end)`` of benchmark windows in the document, sorted, overlapping ones
    too; ``items`` holds the ids whose windows occur. There is one row for all ``n_rows`` rows
    that repeat id and text.

    A window of L words always holds a whole block of (L + 1) / 2 words that begins at a multiple
    of that, so only these blocks are looked up; the windows around a hit are then compared as
    text. The benchmark side is broadcast up to ``BROADCAST_WINDOWS`` windows and joined by a
    shuffle beyond.

    NULL text and text without words have no window. NULL ids are ids like others; an item with a
    NULL id hits but is not listed. An empty benchmark hits nothing; no documents give no rows.
    """
    windows = item_windows(benchmark, item_id_col, item_text_col, window)
    by_length = {r["len"]: r["n"] for r in
                 windows.groupBy("len").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounded = sum(by_length.values()) <= BROADCAST_WINDOWS
    lengths = sorted(by_length) or [window]

    k = F.floor((F.col("len") + 1) / 2).cast("int")
    words = F.split("gram", " ")
    blocks = (
        windows.withColumn("words", words)
        .withColumn("from", F.explode(F.sequence(F.lit(1), F.col("len") - k + 1)))
        .select(F.xxhash64("len", F.array_join(F.slice("words", F.col("from"), k), " "))
                .alias("block"))
        .distinct()
        .withColumn("known", F.lit(True))
    )

    own = F.array(
        F.struct(
            F.lit(None).cast("int").alias("len"),
            F.lit(None).cast("int").alias("at"),
            F.xxhash64("k1", "k2").alias("block"),  # spread, and no hit even if one had it
            F.lit(None).cast("string").alias("around"),
        )
    )
    parts = (
        docs.select(
            col(id_col).alias("id"),
            *row_key(id_col, text_col),
            word_array(text_of(text_col)).alias("words"),
        )
        .select(
            "id", "k1", "k2", F.size("words").alias("n_words"),
            F.explode(F.concat(own, *[_blocks(n) for n in lengths])).alias("part"),
        )
        .select("id", "k1", "k2", "n_words", "part.*")
    )
    hit = parts.join(_bounded(blocks, bounded), "block", "left").where(
        F.col("len").isNull() | F.col("known")
    )
    tried = hit.select(
        "id", "k1", "k2", "n_words", "len", F.explode(_windows()).alias("w")
    ).select("id", "k1", "k2", "n_words", "len", "w.start", "w.gram")
    # A document's own row has no length; its hash keeps such rows apart when this is shuffled.
    keyed = tried.select(
        "id", "k1", "k2", "n_words", "len", "start",
        F.coalesce("len", F.lit(-1)).alias("l"),
        F.coalesce("gram", F.col("k1").cast("string")).alias("g"),
    )
    known = windows.select(F.col("len").alias("l"), F.col("gram").alias("g"), "items")
    matched = keyed.join(_bounded(known, bounded), ["l", "g"], "left").where(
        F.col("len").isNull() | F.col("items").isNotNull()
    )
    span = F.when(
        F.col("len").isNotNull(),
        F.struct(F.col("start").alias("start"), (F.col("start") + F.col("len")).alias("end")),
    )
    return (
        matched.groupBy("k1", "k2")
        .agg(
            F.first("id").alias("id"),
            F.count(F.when(F.col("len").isNull(), 1)).alias("n_rows"),
            F.first("n_words").alias("n_words"),
            F.collect_set(span).alias("spans"),
            F.collect_set("items").alias("items"),
        )
        .select(
            "k1", "k2", "id", "n_rows",
            F.col("n_words").cast("long").alias("n_words"),
            F.array_sort("spans").alias("spans"),
            F.array_distinct(F.flatten("items")).alias("items"),
        )
    )


def covered(spans: Column) -> Column:
    """How many words sorted spans cover."""
    zero = F.lit(0).cast("int")
    return F.aggregate(
        spans,
        F.struct(zero.alias("end"), zero.cast("long").alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["end"]).alias("end"),
            (s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["end"]), zero)).alias("n"),
        ),
        lambda s: s["n"],
    )


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """The rule: a twentieth of the words or more is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_documents(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """The documents that are not contaminated, with their columns as they are."""
    found = find_contamination(docs, benchmark, **names)
    n = covered(F.col("spans"))
    bad = found.where(contaminated(n, F.col("n_words"))).select("k1", "k2")
    a, b = unused(docs, "k1", "k2")
    k1, k2 = row_key(names.get("id_col", "doc_id"), names.get("text_col", "text"))
    return (
        docs.withColumns({a: k1, b: k2})
        .join(bad.toDF(a, b), [a, b], "left_anti")
        .select(*[col(c) for c in docs.columns])
    )


def remove_spans(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """All documents, without the words that benchmark windows hit.

    What stands between such a word and the next word goes with it; all else stays as it is.
    """
    text_col = names.get("text_col", "text")
    found = find_contamination(docs, benchmark, **names).where(F.size("spans") > 0)
    a, b, gone = unused(docs, "k1", "k2", "gone")
    k1, k2 = row_key(names.get("id_col", "doc_id"), text_col)
    every = F.transform("spans", lambda s: F.sequence(s["start"], s["end"] - 1))
    hit = found.select("k1", "k2", F.array_distinct(F.flatten(every))).toDF(a, b, gone)
    words = F.regexp_extract_all(col(text_col), F.lit(WORD), F.lit(0))
    gaps = F.split(col(text_col), WORD)
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(words) - 1), col(gone)),
        lambda i: F.concat(F.element_at(words, i + 1), F.element_at(gaps, i + 2)),
    )
    rest = F.concat(F.element_at(gaps, 1), F.array_join(kept, ""))
    text = F.when(col(gone).isNull(), col(text_col)).otherwise(rest)
    return (
        docs.withColumns({a: k1, b: k2})
        .join(hit, [a, b], "left")
        .select(*[text.alias(c) if c == text_col else col(c) for c in docs.columns])
    )

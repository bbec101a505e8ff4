"""Secrets in texts: sure ones by their form, weak ones where their other parts stand nearby."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.llm.common import col, cut, row_key, text_of

# The forms of secrets, in Java's notation. Kinds are listed in their order.
ASSIGN = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_CHARS = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# A run of forty characters of base 64 can be the secret part of an access key, or anything.
KEY_PART = "[A-Za-z0-9/+]{40,}"
KEY_CHARS = 40
ENDPOINT = "[a-z][a-z0-9]{1,9}://[A-Za-z0-9.-]+(?::[0-9]+)?"
KINDS = ("assign", "access", "hex", "key_part", "endpoint")

SPAN = "array<struct<start:int,kind:int,end:int>>"


BLOCK = 256


def _sums(numbers: Column) -> Column:
    """Running sums of a short array."""
    return F.aggregate(
        numbers,
        F.array().cast("array<int>"),
        lambda out, x: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + x)),
    )


def running_sums(numbers: Column) -> Column:
    """Running sums of an array, block by block: a growing array is copied with each number, so it
    has to stay short. The lambda's argument holds the array, so it is made once for all blocks."""
    return F.element_at(F.transform(F.array(numbers), _block_sums), 1)


def _block_sums(numbers: Column) -> Column:
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
        lambda k: F.slice(numbers, k * BLOCK + 1, F.lit(BLOCK)),
    )
    inside = F.transform(blocks, _sums)
    ends = _sums(F.transform(inside, lambda b: F.element_at(b, -1)))
    return F.flatten(
        F.zip_with(
            inside,
            F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1)),
            lambda block, before: F.transform(block, lambda x: x + before),
        )
    )


def spans_of(text: Column, pattern: str, kind: int, keep: Column | None = None) -> Column:
    """``(start, kind, end)`` of a pattern's matches, leftmost ones that don't overlap.

    The texts between the matches give the places. ``keep`` is an array of booleans, by match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, F.char_length)
    gaps = F.transform(F.slice(F.split(text, pattern), F.lit(1), F.size(found)), F.char_length)
    ends = running_sums(F.zip_with(gaps, sizes, lambda gap, hit: gap + hit))
    placed = F.zip_with(
        ends, sizes,
        lambda end, size: F.struct(
            (end - size).alias("start"), F.lit(kind).alias("kind"), end.alias("end")
        ),
    ).cast(SPAN)
    if keep is not None:
        # An array that a lambda takes from outside is made anew for each element.
        kept = F.zip_with(placed, keep, lambda span, good: F.when(good, span))
        placed = F.filter(kept, lambda span: span.isNotNull())
    return F.when(text.rlike(pattern), placed).otherwise(F.array().cast(SPAN))


def parts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, k1, k2`` and an array of spans for each kind, one row for each document."""
    text = text_of(text_col)
    long_enough = F.transform(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)),
        lambda value: F.char_length(value) >= ASSIGN_CHARS,
    )
    mixed = F.transform(
        F.regexp_extract_all(text, F.lit(KEY_PART), F.lit(0)),
        lambda run: (F.char_length(run) == KEY_CHARS)
        & run.rlike("[a-z]") & run.rlike("[A-Z]") & run.rlike("[0-9]"),
    )
    return docs.select(
        col(id_col).alias("id"),
        *row_key(id_col, text_col),
        spans_of(text, ASSIGN, 0, long_enough).alias("assign"),
        spans_of(text, ACCESS, 1).alias("access"),
        spans_of(text, HEX, 2).alias("hex"),
        spans_of(text, KEY_PART, 3, mixed).alias("key_part"),
        spans_of(text, ENDPOINT, 4).alias("endpoint"),
    )


def near(weak: DataFrame, anchors: DataFrame, reach: int) -> DataFrame:
    """The weak spans with an anchor of their document whose start is ``reach`` away at most.

    Both have ``k1, k2, span``. Places are cut into scopes of ``reach``; a scope keeps only its
    first and last anchor, which is enough to tell, so no scope's pairs are written out: a weak
    span meets three rows at most.
    """
    scope = F.floor(F.col("span.start") / reach)
    scopes = anchors.groupBy("k1", "k2", scope.alias("scope")).agg(
        F.min("span.start").alias("first"), F.max("span.start").alias("last")
    )
    tried = weak.select("k1", "k2", "span", scope.alias("own")).withColumn(
        "scope", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1))
    )
    start = F.col("span.start")
    gap = F.least(F.abs(start - F.col("first")), F.abs(start - F.col("last")))
    return (
        tried.join(scopes, ["k1", "k2", "scope"])
        .where(gap <= reach)
        .select("k1", "k2", "span")
        .distinct()
    )


def link_parts(parts: DataFrame, reach: int) -> DataFrame:
    """``k1, k2, linked``: the weak spans of each document that their complements confirm.

    A key part needs an access identifier in reach. An endpoint needs both an access identifier
    and a secret, assigned or a confirmed key part.
    """
    able = parts.where(
        (F.size("access") > 0) & (F.size("key_part") + F.size("endpoint") > 0)
    ).dropDuplicates(["k1", "k2"])

    def of(kind: str) -> DataFrame:
        return able.select("k1", "k2", F.explode(kind).alias("span"))

    keys = near(of("key_part"), of("access"), reach)
    secrets = keys.unionByName(of("assign"))
    ends = near(near(of("endpoint"), of("access"), reach), secrets, reach)
    return (
        keys.unionByName(ends)
        .groupBy("k1", "k2")
        .agg(F.collect_list("span").alias("linked"))
    )


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 300
) -> DataFrame:
    """``id, base, spans`` for every row: sorted structs ``(start, kind, end)`` in code points,
    end exclusive, with kinds numbered as in ``KINDS``.

    ``base`` has assignments, access identifiers and hexadecimal runs, as their forms say.
    ``spans`` has them and the weak candidates (key parts, endpoints) whose complementary parts
    are within ``reach`` code points, in the same document.

    Texts are scanned once; only the spans found are stored for linking and joined. NULL text is
    empty and has no spans. NULL ids are carried along; repeated rows all come back; an empty
    table gives no rows. Spans of different kinds may overlap.
    """
    parts = cut(parts_of(docs, id_col, text_col))
    base = F.concat("assign", "access", "hex")
    return parts.join(link_parts(parts, reach), ["k1", "k2"], "left").select(
        "id",
        F.array_sort(base).alias("base"),
        F.array_sort(F.concat(base, F.coalesce("linked", F.array().cast(SPAN)))).alias("spans"),
    )


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
                s["end"].cast("string"),
            ),
        ),
        ",",
    )

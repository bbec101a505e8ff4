"""Languages by character models: interpolated Kneser-Ney, one model for each language."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from casetrends.llm.common import col, cut, unused

ORDER = 4
#: Characters of 16 bits, so that the grams of the longest order are exact 64-bit numbers.
BITS = 16
PAD = " " * (ORDER - 1)
NOT_LETTERS = re.compile(r"[\W\d_]+")
SURROGATES = range(0xD800, 0xE000)
_CHARACTERS = [chr(c) for c in range(1 << BITS)]
#: Each character of 16 bits, a space for what is no letter; surrogates stay.
LETTERS = np.array(
    [c if c in SURROGATES or not NOT_LETTERS.match(x) else 32 for c, x in enumerate(_CHARACTERS)], "<u2"
)
ALPHA = np.array([c in SURROGATES or x.isalpha() for c, x in enumerate(_CHARACTERS)])
#: Characters that are looked at together, so that their grams stay in a core's cache.
CHUNK = 1 << 18


def normalised(text: str | None) -> str | None:
    """Letters in lower case with one space between runs of them; None where there is no letter."""
    plain = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return plain if any(map(str.isalpha, plain)) else None


def _coded(text: str | None) -> bytes:
    """The text in lower case, in 16 bits; ``normalised`` where a character needs more."""
    lower = (text or "").lower()
    coded = lower.encode("utf-16-le", "surrogatepass")
    if len(coded) != 2 * len(lower):
        coded = (normalised(lower) or "").encode("utf-16-le", "surrogatepass")
    return coded


def grams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of the longest order of all ``normalised`` texts in turn, and how many each text
    has: none without a letter.

    A text has ``PAD`` before it and a space after it. All texts are normalised together: of each
    run of other characters the first one that follows a letter stays, as a space.
    """
    if not len(texts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    parts = [_coded(t) for t in texts]
    pad, space = PAD.encode("utf-16-le"), " ".encode("utf-16-le")
    codes = LETTERS[np.frombuffer(pad + (space + pad).join(parts) + space, "<u2")]
    sizes = np.array([len(p) // 2 for p in parts], np.int64) + ORDER
    first = np.cumsum(sizes) - sizes
    letter = codes != 32
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    for k in range(ORDER - 1):
        keep[first + k] = True
    some = np.logical_or.reduceat(ALPHA[codes], first)
    if not some.all():
        keep &= np.repeat(some, sizes)
    kept = codes[keep]
    sizes = np.add.reduceat(keep, first, dtype=np.int64)
    if not len(kept):
        return np.zeros(0, np.uint64), sizes
    pairs = (kept[:-1].astype(np.uint32) << np.uint32(BITS)) | kept[1:]
    packed = (pairs[:-2].astype(np.uint64) << np.uint64(2 * BITS)) | pairs[2:]
    inside = np.ones(len(packed), bool)
    ends = np.cumsum(sizes[some])
    for back in range(1, ORDER):  # those that reach from one text into the next
        inside[ends[:-1] - back] = False
    return packed[inside], np.where(some, sizes - ORDER + 1, 0)


def chunks(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``CHUNK`` characters, or of one longer text."""
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
        yield low, high
        low = high


def count_grams(train: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n`` over all texts, pre-aggregated by batch before they are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                texts = part["text"].tolist()
                counted = [
                    np.unique(grams(texts[low:high])[0], return_counts=True) for low, high in chunks(texts)
                ]
                found, at = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
                n = np.zeros(len(found), np.int64)
                np.add.at(n, at, np.concatenate([n for _, n in counted]))
                if len(found):
                    yield pd.DataFrame({"lang": lang, "gram": found.view(np.int64), "n": n})

    return (
        train.select(col(lang_col).alias("lang"), col(text_col).alias("text"))
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .mapInPandas(run, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``lang, size, gram, p, back``: interpolated probabilities of all grams of all sizes.

    ``p`` is the probability of a gram's last character after the others; ``back`` the weight
    that is left, after this gram, for what never followed it. The longest size uses counts,
    shorter ones the number of different characters before the gram, each less its discount.
    """
    levels = {ORDER: counts.select("lang", "gram", F.col("n").cast("double").alias("n"))}
    for size in range(ORDER - 1, 0, -1):
        mask = F.lit((1 << (BITS * size)) - 1).cast("long")
        levels[size] = (
            levels[size + 1]
            .groupBy("lang", F.col("gram").bitwiseAND(mask).alias("gram"))
            .agg(F.count(F.lit(1)).cast("double").alias("n"))
        )
    rest = None
    out = []
    for size in range(1, ORDER + 1):
        level = levels[size]
        ones, twos = (F.count_if(F.col("n") == k) for k in (1, 2))
        discount = level.groupBy("lang").agg(
            F.greatest(F.lit(0.1), F.least(F.lit(0.9), F.coalesce(
                F.try_divide(ones, ones + 2 * twos), F.lit(0.5)))).alias("d")
        )
        context = F.shiftrightunsigned("gram", BITS) if size > 1 else F.lit(0).cast("long")
        after = Window.partitionBy("lang", "context")
        rows = (
            level.join(F.broadcast(discount), "lang")  # a row for each language
            .withColumn("context", context)
            .withColumn("total", F.sum("n").over(after))
            .withColumn("left", F.col("d") * F.count(F.lit(1)).over(after) / F.col("total"))
        )
        own = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")
        if size == 1:
            # Below the single characters lies the same chance for each of 2^16.
            made = rows.select("lang", "gram", "context", "left",
                               (own + F.col("left") / (1 << BITS)).alias("p"))
        else:
            mask = F.lit((1 << (BITS * (size - 1))) - 1).cast("long")
            made = (
                rows.withColumn("lower", F.col("gram").bitwiseAND(mask))
                .join(rest.select("lang", F.col("gram").alias("lower"), F.col("p").alias("q")),
                      ["lang", "lower"])
                .select("lang", "gram", "context", "left",
                        (own + F.col("left") * F.col("q")).alias("p"))
            )
        made = cut(made)
        rest = made.select("lang", "gram", "p")
        out.append(made.select("lang", F.lit(size).alias("size"), "gram", "p"))
        # Kept at the context, which is a gram of the size below.
        out.append(
            made.groupBy("lang", F.col("context").alias("gram"))
            .agg(F.first("left").alias("p"))
            .select("lang", F.lit(-size).alias("size"), "gram", "p")
        )
    joined = out[0]
    for part in out[1:]:
        joined = joined.unionByName(part)
    return joined


class Places:
    """Where each of some different 64-bit numbers stands, by a hash table with open addresses."""

    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys)).bit_length() + 2)
        self.keys, self.last = keys, np.int64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.table = np.full(1 << bits, -1)
        rest, slot = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            free = self.table[slot] < 0
            self.table[slot[free]] = rest[free]
            later = self.table[slot] != rest
            rest, slot = rest[later], (slot[later] + 1) & self.last

    def _slot(self, packed: np.ndarray) -> np.ndarray:
        return ((packed * self.MIX) >> self.shift).view(np.int64)

    def find(self, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each number, and whether it has one."""
        if not len(self.keys):
            return np.zeros(len(packed), np.int64), np.zeros(len(packed), bool)
        slot = self._slot(packed)
        at = self.table.take(slot)
        met = at >= 0
        known = (self.keys.take(at, mode="wrap") == packed) & met
        rest = np.flatnonzero(met & ~known)
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.last
            at[rest] = self.table[slot[rest]]
            met = at[rest] >= 0
            equal = met & (self.keys[at[rest]] == packed[rest])
            known[rest[equal]] = True
            rest = rest[met & ~equal]
        return at, known


@dataclass
class Models:
    """Sorted arrays of exact grams for each size: known grams, and by language what each scores.

    ``scores[k]`` has the log-probability of a gram; ``leaves[k]`` the log-weight a context leaves.
    """

    langs: list[str]
    floor: float
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    scores: dict[int, np.ndarray] = field(default_factory=dict)
    context_keys: dict[int, np.ndarray] = field(default_factory=dict)
    leaves: dict[int, np.ndarray] = field(default_factory=dict)
    limits: np.ndarray = field(default_factory=lambda: np.zeros(0))
    places: Places | None = None
    columns: list[np.ndarray] = field(default_factory=list)

    def fill(self, rows: pa.Table) -> Models:
        """These models with the arrays of ``size, gram, values``."""
        sizes = rows["size"].to_numpy()
        packed = rows["gram"].to_numpy().view(np.uint64)
        values = rows["values"].combine_chunks().flatten().to_numpy().reshape(-1, len(self.langs))
        for size in range(1, ORDER + 1):
            for sign, keys, tables in (
                (1, self.keys, self.scores), (-1, self.context_keys, self.leaves)
            ):
                mine = np.flatnonzero(sizes == sign * size)
                mine = mine[np.argsort(packed[mine])]
                keys[size], tables[size] = packed[mine], values[mine]
        return self

    @staticmethod
    def _find(keys: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, packed)
        at[at == len(keys)] = 0
        return at, (keys[at] == packed) if len(keys) else np.zeros(len(packed), bool)

    def score(self, packed: np.ndarray, size: int = ORDER) -> np.ndarray:
        """Log-probability of each gram in each language; what no language knows goes on to the
        shorter gram, at the weight its context leaves."""
        if size == 0:
            return np.full((len(packed), len(self.langs)), self.floor, np.float32)
        out = np.empty((len(packed), len(self.langs)), np.float32)
        at, known = self._find(self.keys[size], packed)
        out[known] = self.scores[size][at[known]]
        if not known.all():
            rest = packed[~known]
            out[~known] = self._left(rest, size) + self.score(
                rest & np.uint64((1 << (BITS * (size - 1))) - 1), size - 1
            )
        return out

    def _left(self, packed: np.ndarray, size: int) -> np.ndarray:
        at, known = self._find(self.context_keys[size], packed >> np.uint64(BITS))
        out = np.zeros((len(packed), len(self.langs)), np.float32)
        out[known] = self.leaves[size][at[known]]
        return out

    def entropies(self, texts: Sequence[str | None]) -> np.ndarray:
        """Mean negative log-probability of a character, by text and language; NaN without a letter."""
        if self.places is None:
            self.places = Places(self.keys[ORDER])
            self.columns = [x.astype(np.float64) for x in np.ascontiguousarray(self.scores[ORDER].T)]
        packed, sizes = grams(texts)
        total = np.zeros((len(texts), len(self.langs)))
        (own,) = np.nonzero(sizes)
        ends = np.cumsum(sizes[own])
        first = ends - sizes[own]
        for a in range(0, len(packed), CHUNK):
            some = packed[a : a + CHUNK]
            mine = slice(np.searchsorted(ends, a, side="right"), np.searchsorted(first, a + len(some)))
            begin = np.maximum(first[mine] - a, 0)
            at, known = self.places.find(some)
            new = np.flatnonzero(~known)
            at[new] = 0
            backed = self.score(some[new])
            for k in range(len(self.langs)):
                scored = self.columns[k].take(at) if len(self.columns[k]) else np.zeros(len(some))
                scored[new] = backed[:, k]
                total[own[mine], k] += np.add.reduceat(scored, begin)
        return -total / np.where(sizes, sizes, np.nan)[:, None]

    def of_texts(self, texts: Iterable[str | None]) -> list[list[float] | None]:
        """The entropies of each text; None where it has no letter.

        A few texts at a time, so that memory follows the longest text, not the batch.
        """
        texts = list(texts)
        out: list[list[float] | None] = []
        for low, high in chunks(texts):
            found = self.entropies(texts[low:high])
            none = np.isnan(found[:, 0])
            out += [None if n else row for n, row in zip(none, found.tolist())]
        return out


@dataclass
class StoredModels:
    """Models that stay in Spark: ``size, gram, values`` as ``score_rows`` gives them."""

    langs: list[str]
    floor: float
    rows: DataFrame
    limits: np.ndarray = field(default_factory=lambda: np.zeros(0))


def score_rows(probabilities: DataFrame, langs: list[str], floor: float) -> DataFrame:
    """``size, gram, values``: a row for each gram that any language knows.

    ``values`` has a number for each language: the log-probability of the gram, and where the
    language never saw it what backing off gives; at the size less than 0 the log-weight that
    the gram leaves as a context, 0 where the language never saw it.
    """
    named = probabilities.select(
        "size", "gram", F.log("p").alias("p"),
        F.array_position(F.array(*[F.lit(lang) for lang in langs]), F.col("lang"))
        .cast("int").alias("k"),
    )
    seen = cut(
        named.groupBy("size", "gram")
        .agg(F.map_from_entries(F.collect_list(F.struct("k", "p"))).alias("seen"))
    )

    def each(value: Callable[[Column], Column]) -> Column:
        places = F.array(*[F.lit(k + 1) for k in range(len(langs))])
        return F.transform(places, lambda k: value(k).cast("float"))

    left = seen.where(F.col("size") < 0).select(
        "size", "gram", each(lambda k: F.coalesce(F.col("seen")[k], F.lit(0.0))).alias("values")
    )
    out, lower = [left], None
    for size in range(1, ORDER + 1):
        own = seen.where(F.col("size") == size)
        leaves = left.where(F.col("size") == -size).withColumnRenamed("values", "left")
        if size == 1:  # one context, the empty one
            backed = own.crossJoin(F.broadcast(leaves.select("left"))).withColumn(
                "lower", F.array_repeat(F.lit(floor), len(langs))
            )
        else:
            mask = F.lit((1 << (BITS * (size - 1))) - 1).cast("long")
            backed = (
                own.withColumn("context", F.shiftrightunsigned("gram", BITS))
                .join(leaves.select(F.col("gram").alias("context"), "left"), "context")
                .withColumn("suffix", F.col("gram").bitwiseAND(mask))
                .join(lower.select(F.col("gram").alias("suffix"), F.col("values").alias("lower")),
                      "suffix")
            )
        lower = cut(
            backed.select("size", "gram", each(
                lambda k: F.coalesce(
                    F.col("seen")[k], F.element_at("left", k) + F.element_at("lower", k))
            ).alias("values"))
        )
        out.append(lower)
    joined = out[0]
    for part in out[1:]:
        joined = joined.unionByName(part)
    return joined


def fit_models(
    train: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_mb: int = 200,
    tail: float = 0.005,
) -> Models | StoredModels | None:
    """Models of all grams of all labelled texts; None where there is none.

    Up to ``max_mb`` (16 bytes for each gram and language) they are arrays on the driver, larger
    ones stay in Spark; both score the same. A language's limit is the cross-entropy that the
    share ``tail`` of all its own texts exceeds, and a tenth more.
    """
    counts = cut(count_grams(train, text_col, lang_col))
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    floor = float(np.log(2.0**-BITS))
    rows = score_rows(kneser_ney(counts), langs, floor)
    if 16 * rows.count() * len(langs) <= max_mb * 1e6:
        models = Models(langs, floor).fill(rows.toArrow())
    else:
        models = StoredModels(langs, floor, rows)
    place = F.array_position(F.array(*[F.lit(lang) for lang in langs]), F.col("lang"))
    labelled = train.select(col(lang_col).alias("lang"), col(text_col).alias("text"))
    own = (
        with_entropies(labelled.where(F.col("lang").isNotNull()), models, "text", "h")
        .where(F.col("h").isNotNull())
        .select(place.cast("int").alias("k"), "h")
        .select("k", F.element_at("h", F.col("k")).alias("h"))
    )
    models.limits = np.full(len(langs), np.inf)
    for r in own.groupBy("k").agg(F.percentile_approx("h", 1 - tail).alias("h")).collect():
        models.limits[r["k"] - 1] = 1.1 * r["h"]
    return models


def with_entropies(
    docs: DataFrame, models: Models | StoredModels, text_col: str, name: str
) -> DataFrame:
    """All columns and ``name``: the cross-entropy by character in each language, NULL where a
    text has no letter."""
    if isinstance(models, StoredModels):
        return _joined_entropies(docs, models, text_col, name)
    sent = docs.sparkSession.sparkContext.broadcast(vars(models))

    @F.pandas_udf("array<double>")
    def entropies(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Models(**sent.value)
        for texts in batches:
            yield pd.Series(known.of_texts(texts), index=texts.index, dtype=object)

    return docs.select("*", entropies(col(text_col)).alias(name))


def _joined_entropies(
    docs: DataFrame, models: StoredModels, text_col: str, name: str
) -> DataFrame:
    """The same where the models stay in Spark: groups of rows, so large that the grams they can
    hold fit in a task, meet the models' rows for these grams and for what they back off to."""
    langs, floor = models.langs, models.floor
    room = max(1 << 14, (1 << 27) // (24 * (len(langs) + 2)))
    (group,) = unused(docs, "group")
    place = docs.columns.index(text_col)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, size = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            chars = pc.fill_null(pc.utf8_length(batch.column(place)), 0).to_numpy(False)
            # Short rows count by what their other columns hold.
            ends = size + np.cumsum(chars + batch.nbytes // max(batch.num_rows, 1))
            size = int(ends[-1]) if len(ends) else size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first + ends.astype(np.int64) // room)],
                names=[*batch.schema.names, group],
            )

    fields = T.StructType([*docs.schema.fields, T.StructField(group, T.LongType())])
    # Stored, so that a row is in the same group each time it is read.
    dealt = cut(docs.mapInArrow(deal, fields))

    def wanted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, part in batch.groupby("group"):
                found = np.unique(grams(part["text"].tolist())[0])
                if not len(found):
                    continue
                for size in range(ORDER, 0, -1):
                    shift, mask = np.uint64(BITS), np.uint64((1 << (BITS * (size - 1))) - 1)
                    contexts = np.unique(found >> shift)
                    for sign, keys in ((1, found), (-1, contexts)):
                        yield pd.DataFrame(
                            {"group": k, "size": sign * size, "gram": keys.view(np.int64)}
                        )
                    found = np.unique(found & mask)

    needed = (
        dealt.select(F.col(group).alias("group"), col(text_col).alias("text"))
        .where(F.col("text").isNotNull())
        .mapInPandas(wanted, "group long, size int, gram long")
        .distinct()
    )
    rows = needed.join(models.rows, ["size", "gram"])

    def judge(mine: pa.Table, known: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return out_schema.empty_table()
        found = Models(langs, floor).fill(known).of_texts(mine.column(place).to_pylist())
        return mine.drop_columns([group]).append_column(
            name, pa.array(found, pa.list_(pa.float64()))
        )

    fields = T.StructType(
        [*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]
    )
    out_schema = to_arrow_schema(fields)
    return (
        dealt.groupBy(col(group)).cogroup(rows.groupBy("group")).applyInArrow(judge, fields)
    )


def predict(
    docs: DataFrame, models: Models | StoredModels | None, text_col: str, name: str = "language"
) -> DataFrame:
    """All columns and a struct ``name``: ``lang``, ``score`` (0 to 1) and ``accepted``.

    The language with the least cross-entropy by character is chosen; ``score`` is its share
    when likelihoods of a text of 20 such characters are compared, and ``accepted`` is false
    where its cross-entropy is beyond its limit. Texts that are NULL or have no letter, and all
    texts where nothing was learned, are ``und`` with score 0. A column of that name is replaced.
    """
    others = [col(c) for c in docs.columns if c != name]

    def said(lang: Column, score: Column, accepted: Column) -> Column:
        return F.struct(lang.alias("lang"), score.alias("score"), accepted.alias("accepted"))

    nothing = said(F.lit("und"), F.lit(0.0), F.lit(False))
    if models is None:
        return docs.select(*others, nothing.alias(name))
    (h,) = unused(docs, "h")
    found = with_entropies(docs, models, text_col, h)
    least = F.array_min(h)
    top = F.array_position(h, least).cast("int")
    total = F.aggregate(h, F.lit(0.0), lambda all_, x: all_ + F.exp(20 * (least - x)))
    langs = F.array(*[F.lit(lang) for lang in models.langs])
    limits = F.array(*[F.lit(float(x)) for x in models.limits])
    best = said(F.element_at(langs, top), 1 / total, least <= F.element_at(limits, top))
    return found.select(
        *others, F.when(F.col(h).isNull(), nothing).otherwise(best).alias(name)
    )

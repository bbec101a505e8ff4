"""Phrases that stand together more often than their parts, from an index of each shard."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casetrends.llm.common import UPPER, col, shared_folder, tidy_session

# What ends a piece becomes a full stop, which is no part of any word.
ENDS = ".,;:!?\n\x0b\x0c\r"
TO_PLAIN = bytes.maketrans((UPPER + ENDS).encode(), (UPPER.lower() + "." * len(ENDS)).encode())
DEPTH = 4


def plain_texts(texts: pa.Array) -> pa.Array:
    """The texts, non-null, with A-Z lower-cased and each end of a piece a word of its own."""
    texts = texts.fill_null("")
    valid, offsets, data = texts.buffers()
    data = pa.py_buffer(bytes(data or b"").translate(TO_PLAIN))
    changed = pa.Array.from_buffers(texts.type, len(texts), [valid, offsets, data], 0, texts.offset)
    return pc.replace_substring(pc.binary_join_element_wise(changed, ".", ""), ".", " . ")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of words (0 ends a piece), the words (the first is no word), and where each text
    begins."""
    runs = pc.split_pattern(pc.replace_substring(plain_texts(texts), "\t", " "), " ")
    coded = runs.flatten().dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
    stop = pc.equal(words, ".").to_numpy(zero_copy_only=False)
    real = ~(empty | stop)
    new = np.where(real, np.cumsum(real), 0)
    kept = ~empty[number]
    begins = np.concatenate([[0], np.cumsum(kept)])[
        np.asarray(runs.offsets, np.int64) - runs.offsets[0].as_py()
    ]
    named = pa.concat_arrays([pa.array(["."], words.type), words.filter(pa.array(real))])
    return new[number[kept]], named, begins


class PhraseIndex:
    """A bidirectional FM-index over word numbers, 0 ending a piece.

    Suffixes are sorted by their first ``DEPTH`` words only: intervals of patterns shorter than that
    extend as in a full sort. An interval is a pattern's place among the sorted suffixes (``low``,
    ``high``) and, of its mirror image, among those of the mirrored text. One transform gives the words
    on the left of an interval, the mirrored one those on the right.
    """

    def __init__(self, text: np.ndarray, n_words: int):
        text = np.concatenate([text, [0]]).astype(np.int64)
        self.n, self.size = len(text), n_words + 1
        self.left = self._transform(text)
        self.right = self._transform(text[::-1])

    def _transform(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The word before each sorted suffix, and sorted (word, row) pairs, to count words by."""
        rank, width = text, 1
        while width < DEPTH:
            after = np.zeros_like(rank)
            after[:-width] = rank[width:]
            _, rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)
            width *= 2
        before = np.roll(text, 1)[np.argsort(rank, kind="stable")]
        return before, np.sort(before * self.n + np.arange(self.n))

    def words(self) -> dict[str, np.ndarray]:
        """All words that occur, as intervals."""
        count = np.bincount(self.left[0], minlength=self.size)
        high = np.cumsum(count)
        word = np.flatnonzero(count)
        word = word[word > 0]
        low = high[word] - count[word]
        return {"words": word[:, None], "low": low, "high": high[word], "low2": low,
                "high2": high[word]}

    def extend(self, found: dict[str, np.ndarray], to_left: bool) -> dict[str, np.ndarray]:
        """All patterns one word longer, on the left or on the right, as intervals."""
        before, pairs = self.left if to_left else self.right
        near, far = ("low", "low2") if to_left else ("low2", "low")
        low = found[near]
        size = found["high"] - found["low"]
        owner = np.repeat(np.arange(len(low)), size)
        row = np.arange(len(owner)) + np.repeat(low - (np.cumsum(size) - size), size)
        key, count = np.unique(owner * self.size + before[row], return_counts=True)
        owner, word = key // self.size, key % self.size
        # The mirrored interval is split by the new words in order; what ends a piece comes first.
        passed = np.cumsum(count) - count
        other = found[far][owner] + passed - passed[np.searchsorted(owner, owner)]
        real = word > 0
        owner, word, count, other = owner[real], word[real], count[real], other[real]
        own = np.searchsorted(pairs, word * self.n + low[owner])
        words = found["words"][owner]
        parts = [word[:, None], words] if to_left else [words, word[:, None]]
        ends = {near: own, far: other}
        return {"words": np.concatenate(parts, 1), "low": ends["low"], "high": ends["low"] + count,
                "low2": ends["low2"], "high2": ends["low2"] + count}


def long_runs(text: np.ndarray, least: int) -> np.ndarray:
    """The text without words in runs of fewer than ``least``, and one end after each run."""
    end = text == 0
    size = np.diff(np.concatenate([[-1], np.flatnonzero(end), [len(text)]])) - 1
    text = np.where((size >= least)[np.cumsum(end)], text, 0)
    again = np.zeros(len(text), bool)
    again[1:] = (text[1:] == 0) & (text[:-1] == 0)
    return text[~again]


def kept_pairs(text: np.ndarray, words: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The text with an end between neighbours that are not among the (packed) pairs."""
    both = (text[:-1] > 0) & (text[1:] > 0)
    key = np.sort(pairs)
    own = packed(words[text[:-1]], words[text[1:]])
    at = np.minimum(np.searchsorted(key, own), len(key) - 1)
    part = np.flatnonzero(both & (key[at] != own)) + 1
    return np.insert(text, part, 0)


def packed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Two words of the corpus in one number."""
    return first << 32 | second


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One text of some, each with its words of the corpus by number (0 where it has none)."""
    words = np.unique(np.concatenate([[0], *(own for _, own in parts)]))
    return np.concatenate([np.append(np.searchsorted(words, own)[text], 0) for text, own in parts]), words


def gathered(
    parts: Iterator[tuple[np.ndarray, np.ndarray]], most: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The texts, as many as have ``most`` words together (or one longer) merged into one."""
    held, size = [], 0
    for text, words in parts:
        if held and size + len(text) > most:
            yield merged(held)
            held, size = [], 0
        held.append((text, words))
        size += len(text)
    if held:
        yield merged(held)


SHARD = (
    "shard long, lang string, ids binary, n int, words array<string>, counts array<long>"
)


def write_shards(docs: DataFrame, lang_col: str, text_col: str, shard_words: int, path: str) -> None:
    """Texts as numbered words: a row for some whole texts of a language.

    A task holds texts of about ``shard_words`` words (or one longer text) and then closes a shard of
    the language that has most of them, so nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        held: dict[str, list[pa.Array]] = {}
        size: Counter[str] = Counter()

        def written(lang: str) -> pa.RecordBatch:
            nonlocal shard
            number, words, _ = split_words(pa.concat_arrays(held.pop(lang)))
            del size[lang]
            counts = np.bincount(number, minlength=len(words))
            counts[0] = 0
            named = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
            often = pa.ListArray.from_arrays(named.offsets, pa.array(counts, pa.int64()))
            shard += 1
            # The split texts are large; a worker that is used again would keep their memory.
            pa.default_memory_pool().release_unused()
            return pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([lang]), _compressed(number),
                 pa.array([len(number)], pa.int32()), named, often],
                names=["shard", "lang", "ids", "n", "words", "counts"],
            )

        for batch in batches:
            texts = batch.column("text").fill_null("")
            # A word and the space before it are two bytes at least; six are common.
            words = pc.binary_length(texts).to_numpy(zero_copy_only=False) // 6 + 1
            part = np.cumsum(words) // (shard_words // 8 + 1)
            begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
            for low, high in zip(begins, [*begins[1:], len(part)]):
                langs = batch.column("lang").slice(low, high - low).dictionary_encode()
                rows = texts.slice(low, high - low)
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    mine = pc.equal(langs.indices, k)
                    held.setdefault(lang, []).append(rows.filter(mine))
                    size[lang] += int(words[low:high][mine.to_numpy(zero_copy_only=False)].sum())
                while size.total() >= shard_words:
                    yield written(size.most_common(1)[0][0])
        for lang in list(held):
            yield written(lang)

    lang = F.coalesce(col(lang_col).cast("string"), F.lit("und"))
    (
        docs.select(lang.alias("lang"), col(text_col).alias("text"))
        .mapInArrow(run, SHARD)
        .write.mode("overwrite").parquet(path)
    )


CODED = "shard long, ids binary, n int, words array<long>"
PAIRS = "shard long, pair long, a long"
LONGER = "p long, q long, a long"
# Words are numbered apart in so many groups.
GROUPS = 1024
# All pairs of all shards are the most that is shuffled at once; they are counted in turns.
TURNS = 2


def _compressed(number: np.ndarray) -> pa.Array:
    return pa.array([pa.compress(number.astype("<i4").tobytes(), codec="zstd", asbytes=True)], pa.binary())


def _unpacked(ids: pa.Scalar, n: int) -> np.ndarray:
    data = pa.decompress(ids.as_buffer(), decompressed_size=4 * n, codec="zstd")
    return np.frombuffer(data, "<i4")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """The numbered words of each row, and the row."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield _unpacked(batch.column("ids")[k], batch.column("n")[k].as_py()), batch.slice(k, 1)


def _list(row: pa.RecordBatch, name: str) -> np.ndarray:
    return row.column(name)[0].values.to_numpy(zero_copy_only=False)


def code_shards(shards: DataFrame, shard_words: int, path: str) -> None:
    """Texts of the words in ``kept`` (``id, word``) only, with the corpus' numbers of their own ones.

    What else stands between them ends a piece. The words of two languages differ in these numbers,
    so small shards of a task are merged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32

        def coded() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for text, row in _texts(batches):
                kept = row.column("kept")[0].values
                number = kept.field("id").to_numpy(zero_copy_only=False)
                words = np.zeros(max(int(text.max(initial=0)), int(number.max())) + 1, np.int64)
                words[number] = kept.field("word").to_numpy(zero_copy_only=False)
                yield text, words

        for text, words in gathered(coded(), shard_words):
            text = long_runs(text, 2)
            shard += 1
            if text.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard]), _compressed(text), pa.array([len(text)], pa.int32()),
                     pa.array([words], pa.list_(pa.int64()))],
                    names=["shard", "ids", "n", "words"],
                )

    shards.select("ids", "n", "kept").mapInArrow(run, CODED).write.parquet(path)


def pairs_of_shards(shards: DataFrame, turn: int) -> DataFrame:
    """``shard, pair, a``: the pairs of words, by shard, as far as their first word has its turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, row in _texts(batches):
            words = _list(row, "words")
            index = PhraseIndex(text, len(words))
            found = index.words()
            mine = words[found["words"][:, 0]] % TURNS == turn
            found = index.extend({k: v[mine] for k, v in found.items()}, to_left=False)
            first, second = words[found["words"]].T
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(first), row.column("shard")[0].as_py())),
                 pa.array(packed(first, second)), pa.array(found["high"] - found["low"])],
                names=["shard", "pair", "a"],
            )

    return shards.select("shard", "ids", "n", "words").mapInArrow(run, PAIRS)


def phrases_of_shards(shards: DataFrame, shard_words: int) -> DataFrame:
    """``p, q, a``: phrases of three and four words all of whose pairs are in ``kept``, as the pairs of
    their first and their last words; a third word stands before 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parted() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for text, row in _texts(batches):
                words = _list(row, "words")
                text = long_runs(kept_pairs(text, words, _list(row, "kept")), 3)
                if text.any():
                    yield text, words

        for text, words in gathered(parted(), shard_words):
            index = PhraseIndex(text, len(words))
            found = index.extend(index.words(), to_left=False)
            # To the left, then to the right again.
            for to_left in (True, False):
                found = index.extend(found, to_left)
                if len(found["low"]):
                    first, second, third, *fourth = words[found["words"]].T
                    last = fourth[0] if fourth else np.zeros_like(third)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(packed(first, second)), pa.array(packed(third, last)),
                         pa.array(found["high"] - found["low"])],
                        names=["p", "q", "a"],
                    )

    return shards.select("ids", "n", "words", "kept").mapInArrow(run, LONGER)


def _total(of: str, *keys: str) -> Column:
    return F.sum(of).over(Window.partitionBy(*keys))


def count_phrases(
    docs: DataFrame, lang_col: str, text_col: str, least: int, shard_words: int
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, m, a``: all phrases of one to four words that occur ``least`` times or more in
    their language, and ``lang, n``: all words.

    A phrase is no more frequent than its parts. So only frequent words take part in the index of
    a shard, then only pairs that are frequent in all shards together; what else stands between
    them ends a piece. Frequent words are numbered for the whole corpus and longer phrases counted by
    these numbers, pairs in the second round and only longer ones in the third. Each round ends in
    a table, and a session of its own lets go of the shuffle files of a round with it.
    """
    folder = shared_folder(docs.sparkSession) + f"/phrases-{uuid.uuid4().hex}"
    spark = tidy_session(docs.sparkSession)

    def stored(name: str, session: SparkSession = spark) -> DataFrame:
        return session.read.parquet(f"{folder}/{name}")

    write_shards(docs, lang_col, text_col, shard_words, f"{folder}/shards")
    own = stored("shards").select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("id", "x"))
    own = own.where("x.counts > 0").select("shard", "lang", "id", F.col("x.words").alias("phrase"), "x.counts")
    own = own.withColumn("part", F.pmod(F.xxhash64("lang", "phrase"), F.lit(GROUPS))).repartition("part")
    words = own.withColumn("a", _total("counts", "part", "lang", "phrase")).where(F.col("a") >= least)
    place = F.dense_rank().over(Window.partitionBy("part").orderBy(F.desc("a"), "lang", "phrase"))
    words = words.withColumn("word", (place.cast("long") - 1) * GROUPS + F.col("part") + 1)
    few = F.when(F.col("word") < 1 << 31, F.col("word"))
    few = few.otherwise(F.raise_error(F.lit("there are too many frequent words")).cast("long"))
    words.select("shard", "id", "lang", "phrase", "a", few.alias("word")).write.parquet(f"{folder}/words")

    def with_kept(shards: DataFrame, kept: DataFrame, item: Column) -> DataFrame:
        return shards.join(kept.groupBy("shard").agg(F.collect_list(item).alias("kept")), "shard")

    numbered = with_kept(stored("shards"), stored("words"), F.struct("id", "word"))
    code_shards(numbered, shard_words // 2, f"{folder}/coded")
    for turn in range(TURNS):
        pairs = pairs_of_shards(stored("coded"), turn)
        frequent = pairs.withColumn("total", _total("a", "pair")).where(F.col("total") >= least)
        frequent.select("shard", "pair", "total").write.mode("append").parquet(f"{folder}/pairs")
    cut = with_kept(stored("coded"), stored("pairs"), F.col("pair"))
    longer = phrases_of_shards(cut, shard_words // 2)
    longer = longer.groupBy("p", "q").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    longer.write.parquet(f"{folder}/longer")
    stored("words").select("word", "lang", "phrase", "a").distinct().write.parquet(f"{folder}/single")

    two = stored("pairs").select(F.col("pair").alias("p"), F.lit(0).cast("long").alias("q"), F.col("total").alias("a"))
    several = two.distinct().unionByName(stored("longer"))
    low = F.lit((1 << 32) - 1)
    numbers = F.array(*(x for c in ("p", "q") for x in (F.shiftright(c, 32), F.col(c).bitwiseAND(low))))
    several = several.select("p", "q", "a", F.posexplode(F.filter(numbers, lambda x: x > 0)).alias("k", "word"))
    (
        several.join(stored("single").select("word", "lang", "phrase"), "word")
        .groupBy("p", "q", "a", "lang")
        .agg(F.sort_array(F.collect_list(F.struct("k", "phrase"))).alias("words"))
        .select("lang", F.array_join("words.phrase", " ").alias("phrase"), "a")
        .write.parquet(f"{folder}/several")
    )
    n = stored("shards", docs.sparkSession).groupBy("lang").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    ).where("n > 0")
    single = stored("single", docs.sparkSession).drop("word")
    found = single.unionByName(stored("several", docs.sparkSession))
    return found.withColumn("m", F.size(F.split("phrase", " "))), n


def mine_phrases(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    least: int = 30,
    covered_percent: int = 80,
    scale: int = 2_000_000,
    shard_words: int = 1 << 21,
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, m, a, l, r, score, covered`` of every phrase of two to four words that occurs
    ``least`` times or more in its language, and ``lang, n``: all words of each language.

    ``l`` and ``r`` count the two parts of the cut with the least score
    ``floor(scale * a / (l + r))``, the first one among equal ones. ``covered`` is true where a longer
    phrase around it occurs at least ``covered_percent`` in a hundred times as often.

    Words are what stands between blanks and tabs, in lower case (A-Z only); a phrase does not
    pass ``.,;:!?`` or the end of a line. Counts are sums over shards and exact, scores exact in
    decimals. Repeated rows count each time; NULL languages are ``und``, NULL texts empty; an
    empty table gives empty frames; other columns are not looked at. A shard holds whole texts, so a
    very long one makes a shard of its own.
    """
    found, n = count_phrases(docs, lang_col, text_col, least, shard_words)
    word = F.split("phrase", " ")

    def part(first: Column | int, size: Column) -> Column:
        return F.array_join(F.slice(word, first, size), " ")

    candidates = found.where("m > 1")
    cuts = candidates.select("lang", "phrase", "m", "a", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k"))
    cuts = cuts.select("*", part(F.lit(1), F.col("k")).alias("p"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("q"))
    left = found.select(F.col("lang").alias("l_lang"), F.col("phrase").alias("l_phrase"), F.col("a").alias("l"))
    right = found.select(F.col("lang").alias("r_lang"), F.col("phrase").alias("r_phrase"), F.col("a").alias("r"))
    scored = (
        cuts.join(left, (F.col("lang") == F.col("l_lang")) & (F.col("p") == F.col("l_phrase")))
        .join(right, (F.col("lang") == F.col("r_lang")) & (F.col("q") == F.col("r_phrase")))
        .withColumn("score", F.expr(
            f"(cast({scale} as decimal(9,0)) * cast(a as decimal(19,0)))"
            " div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))"
        ))
        .groupBy("lang", "phrase", "m", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    )
    inner = F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("m") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("m") - size + 1), lambda at: part(at, size)),
    ))).alias("inner")
    around = (
        candidates.where("m > 2").select("lang", "a", inner)
        .groupBy(F.col("lang").alias("o_lang"), "inner").agg(F.max("a").alias("most"))
    )
    exact = "decimal(22,0)"
    covered = F.coalesce(
        F.col("most").cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)")
        >= (F.col("a").cast("decimal(19,0)") * F.lit(covered_percent).cast("decimal(3,0)")).cast(exact),
        F.lit(False),
    )
    out = scored.join(
        around, (F.col("lang") == F.col("o_lang")) & (F.col("phrase") == F.col("inner")), "left"
    ).select("lang", "phrase", "m", "a", "best.l", "best.r", "best.score", covered.alias("covered"))
    return out, n

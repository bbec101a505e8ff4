"""Quality rules, checked in the order that rejects most per second of work."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.llm.common import col, unused

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
WINDOW = 5


class Measures:
    """Counts of one text; each is made when it is first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        spaces = len(self.data) - len(self.data.translate(None, SPACES))
        return len(self.text) - spaces

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [line for line in self.data.split(b"\n") if line.strip(SPACES)]
        return len(lines) - len(set(lines))

    @cached_property
    def line_marks(self) -> tuple[int, int, int]:
        """Lines with a word, those of them that begin with a bullet, that end with an ellipsis."""
        lines = [x for x in (line.strip(SPACES) for line in self.data.split(b"\n")) if x]
        return (
            len(lines), sum(x.startswith(BULLETS) for x in lines),
            sum(x.endswith(ELLIPSES) for x in lines),
        )

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        n = len(words) - WINDOW + 1
        if n < 2:
            return 0
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        # Pairs of numbers are numbered anew, so that equal numbers always mean equal windows.
        _, two = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        size = int(two.max()) + 1
        _, four = np.unique(two[:-2] * size + two[2:], return_inverse=True)
        _, five, often = np.unique(
            four[:n] * len(number) + ids[4:], return_inverse=True, return_counts=True
        )
        marks = np.zeros(len(words) + 1, np.int64)
        starts = np.flatnonzero(often[five] > 1)
        np.add.at(marks, starts, 1)
        np.add.at(marks, starts + WINDOW, -1)
        return int((np.cumsum(marks)[:-1] > 0).sum())


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_marks")
BULLETS, ELLIPSES = (b"*", b"-", "•".encode()), (b"...", "…".encode())


@dataclass(frozen=True)
class Rule:
    """``fails`` is true for a text to reject; ``needs`` are the measures that it looks at."""

    name: str
    fails: Callable[[Measures], bool]
    needs: tuple[str, ...] = ()


def production_rules(
    min_words: int = 10,
    repeat_percent: int = 20,
    symbols_percent: int = 30,
    dup_lines_percent: int = 50,
    word_length: tuple[int, int] = (2, 20),
    bullets_percent: int = 90,
    ellipses_percent: int = 30,
) -> tuple[Rule, ...]:
    low, high = word_length
    return (
        Rule("few_words", lambda m: m.n_words < min_words, ("n_words",)),
        Rule(
            "repeats", lambda m: 100 * m.n_repeat_words > repeat_percent * m.n_words,
            ("n_words", "n_repeat_words"),
        ),
        Rule(
            "symbols", lambda m: 100 * m.n_symbols > symbols_percent * m.n_words,
            ("n_words", "n_symbols"),
        ),
        Rule(
            "dup_lines",
            lambda m: 100 * m.n_dup_lines > dup_lines_percent * (m.text.count("\n") + 1),
            ("n_dup_lines",),
        ),
        Rule(
            "word_length",
            lambda m: not low * m.n_words <= m.word_chars <= high * m.n_words,
            ("n_words", "word_chars"),
        ),
        Rule(
            "bullets",
            lambda m: 100 * m.line_marks[1] > bullets_percent * m.line_marks[0],
            ("line_marks",),
        ),
        Rule(
            "ellipses",
            lambda m: 100 * m.line_marks[2] > ellipses_percent * m.line_marks[0],
            ("line_marks",),
        ),
    )


@dataclass(frozen=True)
class Sample:
    """What a sample tells: texts by the set of rules (bits) that reject them, seconds a text of
    each measure, and of each rule whose measures are there."""

    rejected: dict[int, int]
    measures: dict[str, float]
    rules: dict[str, float]


def estimate(
    docs: DataFrame, rules: tuple[Rule, ...], text_col: str, sample_rows: int
) -> Sample:
    """Rules and measures timed on a random sample of about ``sample_rows`` texts.

    Each task samples its own rows and adds its timings up. Only the order of the rules depends
    on them.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent = {name: 0.0 for name in (*MEASURES, *(rule.name for rule in rules))}
        masks: Counter[int] = Counter()
        for batch in batches:
            for text in batch["text"]:
                measures, mask = Measures(text), 0
                for name in MEASURES:
                    began = time.perf_counter()
                    getattr(measures, name)
                    spent[name] += time.perf_counter() - began
                for bit, rule in enumerate(rules):
                    began = time.perf_counter()
                    mask |= rule.fails(measures) << bit
                    spent[rule.name] += time.perf_counter() - began
                masks[mask] += 1
        rows = [("", mask, float(n)) for mask, n in masks.items()]
        rows += [(name, 0, seconds) for name, seconds in spent.items() if masks]
        yield pd.DataFrame(rows, columns=["name", "mask", "value"])

    sums = (
        docs.select(col(text_col).alias("text")).sample(share, seed=11)
        .mapInPandas(run, "name string, mask long, value double")
        .groupBy("name", "mask").agg(F.sum("value").alias("value"))
        .collect()
    )
    rejected = {r["mask"]: int(r["value"]) for r in sums if r["name"] == ""}
    texts = max(sum(rejected.values()), 1)
    seconds = {r["name"]: r["value"] / texts for r in sums if r["name"]}
    return Sample(
        rejected, {m: seconds.get(m, 0.0) for m in MEASURES},
        {rule.name: seconds.get(rule.name, 0.0) for rule in rules},
    )


def cascade_order(rules: tuple[Rule, ...], found: Sample) -> tuple[Rule, ...]:
    """The rules by rejections per second, greatest first; as given where they tie.

    A rule counts for the texts that the rules before it let through, and costs what it adds:
    measures that an earlier rule needs are there already.
    """
    left, there = dict(found.rejected), set()
    todo, out = list(range(len(rules))), []
    while todo:

        def worth(bit: int) -> float:
            hits = sum(n for mask, n in left.items() if mask >> bit & 1)
            cost = found.rules.get(rules[bit].name, 0.0) + sum(
                found.measures.get(m, 0.0) for m in rules[bit].needs if m not in there
            )
            return hits / max(cost, 1e-9)

        best = max(todo, key=worth)
        todo.remove(best)
        out.append(rules[best])
        there.update(rules[best].needs)
        left = {mask: n for mask, n in left.items() if not mask >> best & 1}
    return tuple(out)


def rejecting_rule(rules: tuple[Rule, ...]) -> Callable[[Column], Column]:
    """A column function: the first rule that rejects the text, or NULL; later ones don't run."""

    @F.pandas_udf("string")
    def verdict(texts: pd.Series) -> pd.Series:
        def first(text: str | None) -> str | None:
            measures = Measures(text)
            return next((rule.name for rule in rules if rule.fails(measures)), None)

        return pd.Series([first(text) for text in texts], dtype=object)

    return verdict


def plan_cascade(
    docs: DataFrame,
    rules: tuple[Rule, ...] | None = None,
    text_col: str = "text",
    sample_rows: int = 1000,
) -> tuple[Rule, ...]:
    rules = production_rules() if rules is None else rules
    return cascade_order(rules, estimate(docs, rules, text_col, sample_rows))


def quality_filter(
    docs: DataFrame,
    rules: tuple[Rule, ...] | None = None,
    text_col: str = "text",
    sample_rows: int = 1000,
) -> DataFrame:
    """The documents that no rule rejects, with their columns as they are.

    NULL text counts as empty (no words, so it is rejected). Which documents stay does not depend
    on the order of the rules. Repeated rows are judged alike; an empty table stays empty.
    """
    ordered = plan_cascade(docs, rules, text_col, sample_rows)
    (name,) = unused(docs, "rejected_by")
    judged = docs.withColumn(name, rejecting_rule(ordered)(col(text_col)))
    return judged.where(col(name).isNull()).select(*[col(c) for c in docs.columns])


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def counted(texts: Column) -> Column:
    """The counts of a text, whichever rules look at them."""

    @F.pandas_udf(COUNTS)
    def counts(batch: pd.Series) -> pd.DataFrame:
        names = [part.split()[0] for part in COUNTS.split(", ")]
        rows = [[getattr(m, name) for name in names] for m in map(Measures, batch)]
        return pd.DataFrame(rows, columns=names)

    return counts(texts)


def quality_report(
    docs: DataFrame,
    rules: tuple[Rule, ...] | None = None,
    text_col: str = "text",
    sample_rows: int = 1000,
    name: str = "quality",
) -> DataFrame:
    """All columns and a struct ``name`` with every count and ``rejected_by``, the rule of the
    cascade that rejects the text, or NULL.

    The cascade judges as in ``quality_filter``, the counts are made apart from it. A column of
    that name is replaced. NULL text counts as empty; repeated rows are judged alike; an empty
    table gives no rows.
    """
    ordered = plan_cascade(docs, rules, text_col, sample_rows)
    text = col(text_col)
    others = [col(c) for c in docs.columns if c != name]
    n_name, by_name = unused(docs, "counts_", "rejected_")
    judged = docs.select(
        *others, counted(text).alias(n_name), rejecting_rule(ordered)(text).alias(by_name)
    )
    return judged.select(
        *others, F.struct(f"{n_name}.*", F.col(by_name).alias("rejected_by")).alias(name)
    )

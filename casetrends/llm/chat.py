"""Conversations as training windows of a token budget."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casetrends.llm.common import col

# The template's control strings. A turn is written as
# <s>[INST] role [/INST] text</s>
OPEN, NAMED, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
# A control string in a text gets a backslash after its first character, one that already has
# backslashes there gets one more, so that taking one away restores it.
CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>)")
ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?INST\]|<SYS>>|</SYS>>)")
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\] (.*?)</s>", re.S)


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def write_turns(turns: list[tuple[str, str]], masked: int) -> tuple[str, list[tuple[int, int]]]:
    """The text of the turns, and where assistant texts stand in it; not of the first ``masked``."""
    out, loss, at = [], [], 0
    for k, (role, text) in enumerate(turns):
        head, body = OPEN + escape(role) + NAMED, escape(text)
        at += len(head)
        if role == "assistant" and k >= masked:
            loss.append((at, at + len(body)))
        at += len(body) + len(CLOSE)
        out += [head, body, CLOSE]
    return "".join(out), loss


def read_turns(text: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(body)) for role, body in TURN.findall(text)]


def word_tokens(text: Column) -> Column:
    """A cheap stand-in for tokens: runs of letters or digits, and every other visible character."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long")


def _turns(conversations: DataFrame, names: tuple[str, str, str, str], tokens: Column) -> DataFrame:
    """Turns with their tokens and the tokens before them in their conversation.

    The running sums are made for runs of turn numbers first, so that a long conversation is no
    single task.
    """
    conv, turn, role, text = names
    raw = conversations.select(
        col(conv).alias("conv"),
        col(turn).alias("turn"),
        F.coalesce(col(role), F.lit("")).alias("role"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )
    rows = raw.withColumn("tokens", tokens).withColumn("run", F.floor(F.col("turn") / 1024))
    runs = rows.groupBy("conv", "run").agg(F.sum("tokens").alias("in_run"))
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select(
        F.col("conv").alias("b_conv"), F.col("run").alias("b_run"),
        F.coalesce(F.sum("in_run").over(earlier), F.lit(0)).alias("before_run"),
    )
    inside = Window.partitionBy("conv", "run").orderBy("turn", "role", "text").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        rows.join(
            before,
            F.col("conv").eqNullSafe(F.col("b_conv")) & F.col("run").eqNullSafe(F.col("b_run")),
        )
        .withColumn("start", F.col("before_run") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .select("conv", "turn", "role", "text", "tokens", "start")
    )


def plan_windows(
    turns: list[tuple[int, str, str]], system: tuple[str, str] | None, system_tokens: int,
    lead: list[tuple[int, str, str]], budget: int, history: int,
) -> Iterator[tuple[list[tuple[str, str]], int]]:
    """Greedy turn-aligned spans: the turns of each window and how many of them are repeated."""
    at = 0
    past = list(lead)
    # The system turn itself is no history; it comes back by itself.
    first = turns[0] if system is not None and not lead and turns[0][1:] == system else None
    while at < len(turns):
        own = system is not None and not (at == 0 and first is not None)
        spare = budget - (system_tokens if own else 0)
        kept, used = [], 0
        for item in reversed(past):
            if used + item[0] > min(history, spare - turns[at][0]):
                break
            kept.insert(0, item)
            used += item[0]
        end = at
        while end < len(turns) and (end == at or used + turns[end][0] <= spare):
            used += turns[end][0]
            end += 1
        repeated = ([system] if own else []) + [(r, t) for _, r, t in kept]
        yield repeated + [(r, t) for _, r, t in turns[at:end]], len(repeated)
        past = [t for t in turns[at:end] if t is not first]
        at = end


def format_windows(
    conversations: DataFrame,
    names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
    budget: int = 512,
    history: int = 128,
    segment: int = 32_768,
    tokens: Callable[[Column], Column] = word_tokens,
) -> DataFrame:
    """``conv, segment, window, text, loss, n_turns, n_repeated``: the formatted windows.

    Every window has the conversation's system turn (its first turn, if a system one), the last
    turns before it up to ``history`` tokens, then new turns, ``budget`` tokens in all; only a
    turn that alone is too long goes beyond, in a window of its own. The first ``n_repeated``
    turns stand in an earlier window too and bear no loss, so every assistant text is under
    ``loss`` (spans of characters) once. Segments of ``segment`` tokens, cut by the running sums
    of tokens, bound what one task holds of a conversation; a window does not cross them.

    NULL texts and roles are empty; NULL conversations and turns are values like others (NULL
    turns come first); equal turn numbers go by role, then text; repeated rows are repeated
    turns; an empty table gives no windows; other columns are not looked at.
    """
    overhead = 8  # marks of a turn
    turns = _turns(conversations, names, tokens(F.col("text")) + overhead).withColumn(
        "segment", F.floor(F.col("start") / segment)
    )
    kind = "struct<tokens:bigint,role:string,text:string>"
    item = F.struct("tokens", "role", "text").cast(kind)
    # The tail of a segment also leads the next one, and the system turn all others.
    is_head = (F.col("start") == 0) & (F.col("role") == "system")
    tail = turns.where(~is_head & (F.col("start") >= (F.col("segment") + 1) * segment - history))
    lead = tail.select("conv", (F.col("segment") + 1).alias("segment"), "turn", "start", item.alias("item"),
                       F.lit(1).alias("part"))
    head = turns.where(is_head).select(
        "conv", "turn", "start", item.alias("item")
    )
    last = turns.groupBy("conv").agg(F.max("segment").alias("last"))
    systems = (
        head.join(last.withColumnRenamed("conv", "l_conv"), F.col("conv").eqNullSafe(F.col("l_conv")))
        .select("conv", F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("segment"),
                "turn", "start", "item", F.lit(0).alias("part"))
    )
    own = turns.select("conv", "segment", "turn", "start", item.alias("item"), F.lit(2).alias("part"))
    grouped = (
        own.unionByName(lead).unionByName(systems)
        .groupBy("conv", "segment")
        .agg(F.sort_array(F.collect_list(F.struct("part", "start", "turn", "item"))).alias("rows"))
        .where(F.element_at("rows", -1)["part"] == 2)
    )

    window_type = (
        "array<struct<text:string,loss:array<struct<start:int,end:int>>,n_turns:int,n_repeated:int>>"
    )

    @F.pandas_udf(window_type)
    def windows(groups: pd.Series) -> pd.Series:
        out = []
        for rows in groups:
            parts: dict[int, list] = {0: [], 1: [], 2: []}
            for row in rows:
                x = row["item"]
                parts[row["part"]].append((x["tokens"], x["role"], x["text"]))
            system = parts[0][0] if parts[0] else None
            made = []
            for shown, n in plan_windows(
                parts[2], system and system[1:], system[0] if system else 0, parts[1], budget,
                history,
            ):
                text, loss = write_turns(shown, n)
                made.append({
                    "text": text, "loss": [{"start": a, "end": b} for a, b in loss],
                    "n_turns": len(shown), "n_repeated": n,
                })
            out.append(made)
        return pd.Series(out)

    return grouped.select(
        "conv", "segment", F.posexplode(windows("rows")).alias("window", "w")
    ).select("conv", "segment", "window", "w.*")




def read_back(windows: DataFrame) -> DataFrame:
    """What each window newly says: turns as ``role, line feed, text, line feed``, the text under
    its loss mask unescaped, and its length."""
    schema = "struct<n_turns:bigint,turns:string,loss_text:string,formatted_chars:bigint>"

    @F.pandas_udf(schema)
    def parsed(texts: pd.Series, losses: pd.Series, repeated: pd.Series) -> pd.DataFrame:
        rows = []
        for text, loss, n in zip(texts, losses, repeated):
            new = read_turns(text)[n:]
            said = "".join(unescape(text[x["start"] : x["end"]]) for x in loss)
            rows.append((len(new), "".join(f"{r}\n{t}\n" for r, t in new), said, len(text)))
        return pd.DataFrame(rows, columns=["n_turns", "turns", "loss_text", "formatted_chars"])

    return windows.select(
        "conv", "segment", "window", parsed("text", "loss", "n_repeated").alias("p")
    ).select("conv", "segment", "window", "p.*")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

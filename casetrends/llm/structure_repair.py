"""Conversations brought to turns that alternate, with the cheapest edits."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.llm.common import WHITE, col, cut

# Costs of the edits, and what an undeleted truncated row adds.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
SPACE = " "
# Initials read so far: 0 nothing, 1 a system turn, 2 up to a user turn, 3 up to an assistant turn.
# 0 and 3 may end. From every state one of user and assistant may follow, and leads to THEN.
THEN, ENDS = (2, 2, 3, 2), (0, 3)
FAR = 1 << 40
# A row is a letter from A on: three for each of system, user, assistant and other initials;
# first a sound row, then one that must go, then a truncated one.
SOUND, GONE, CUT_OFF = 0, 1, 2
# The edits by their initials, in ASCII order; a small r or i makes an assistant turn.
EDITS = "DIKR"


def keeps(state: int, initial: int) -> int | None:
    """The state after a kept row, or None where its initial can't follow."""
    if initial == 0:
        return 1 if state == 0 else None
    if initial == 1:
        return 2 if state != 2 else None
    return 3 if initial == 2 and state == 2 else None


def inserted(cost: list[int]) -> list[int]:
    """Costs to the end where turns may be put in first."""
    two = min(cost[2], INSERT + cost[3])
    three = min(cost[3], INSERT + cost[2])
    return [min(cost[0], INSERT + two), min(cost[1], INSERT + two), two, three]


def costs_to_go(codes: str, leave: list[int], last: bool) -> list[list[int]]:
    """The least cost to the end from each state before each row, and after the last one.

    ``leave`` has the costs of the states after these rows; ``last`` says that the conversation
    ends here, so that turns may still be put in.
    """
    cost = inserted(leave) if last else leave
    out = [cost]
    for letter in reversed(codes):
        initial, fault = divmod(ord(letter) - 65, 3)
        stay = [DELETE + c for c in cost]
        if fault != GONE:
            more = TRUNCATED if fault == CUT_OFF else 0
            for state in range(4):
                stay[state] = min(stay[state], REROLE + more + cost[THEN[state]])
                then = keeps(state, initial)
                if then is not None:
                    stay[state] = min(stay[state], more + cost[then])
        cost = inserted(stay)
        out.append(cost)
    return out[::-1]


def between(codes: str) -> list[int]:
    """The least cost from each state before the rows to each state after them, row by row."""
    columns = [
        costs_to_go(codes, [0 if state == end else FAR for state in range(4)], False)[0]
        for end in range(4)
    ]
    return [columns[end][state] for state in range(4) for end in range(4)]


@dataclass
class Paths:
    """Nodes (a state before each row, and after the last) of some slices, one after another.

    ``letter`` is each node's edit, ``jumps[k]`` the node 2**k edits on; an end is its own next.
    """

    letter: np.ndarray
    jumps: list[np.ndarray]
    rank: np.ndarray

    def audit(self, node: int) -> tuple[str, int]:
        """The least audit from a node, and the node where it ends."""
        end, length = node, 0
        for k in reversed(range(len(self.jumps))):
            if self.jumps[k][end] != end and self.jumps[0][self.jumps[k][end]] != self.jumps[k][end]:
                end, length = int(self.jumps[k][end]), length + (1 << k)
        if self.jumps[0][end] != end:
            end, length = int(self.jumps[0][end]), length + 1
        steps = np.arange(length)
        nodes = np.full(length, node)
        for k, jump in enumerate(self.jumps):
            nodes = np.where(steps >> k & 1, jump[nodes], nodes)
        return self.letter[nodes].tobytes().decode("ascii"), end


def rank_paths(codes: list[str], leave: list[list[int]], last: list[bool]) -> Paths:
    """Least optimal paths of the nodes of some slices.

    Arcs that keep the least cost are the optimal ones. Audits of length one rank the nodes first;
    then each round ranks those of twice the length, by the rank of a node and the rank of the
    node that its first half leads to. Edits that leave a node have different initials, so the
    arc of the least initial and rank begins the least audit, and audits of optimal paths that
    end in the same place are never prefixes of one another.
    """
    size = np.array([len(c) + 1 for c in codes])
    base = np.cumsum(size) - size
    cost = np.array(
        [c for x in zip(codes, leave, last) for c in costs_to_go(*x)], np.int64
    ).reshape(-1, 4)
    n = len(cost)
    letters = np.zeros(n, np.int64)
    at_end = np.zeros(n, bool)
    at_end[base + size - 1] = True
    letters[~at_end] = np.frombuffer("".join(codes).encode("ascii"), np.uint8).astype(np.int64) - 65
    initial, fault = letters // 3, letters % 3
    last_row = np.repeat(np.array(last, bool), size)
    state = np.arange(4)
    then = np.array(THEN)
    row = np.arange(n)[:, None]
    down = np.minimum(row + 1, n - 1)
    kept = np.array([[-1 if (k := keeps(q, i)) is None else k for i in range(4)] for q in range(4)])
    kept = kept[:, initial].T
    more = np.where(fault == CUT_OFF, TRUNCATED, 0)[:, None]
    stays = (~at_end & (fault != GONE))[:, None]
    target = np.stack([
        down * 4 + state, row * 4 + then, down * 4 + np.maximum(kept, 0), down * 4 + then,
    ], -1)
    price = np.stack(np.broadcast_arrays(DELETE, INSERT, more, REROLE + more + 0 * cost), -1)
    able = np.stack(np.broadcast_arrays(
        ~at_end[:, None], (~at_end | last_row)[:, None], stays & (kept >= 0), stays
    ), -1)
    flat = cost.ravel()
    optimal = able & (price + flat[target] == cost[:, :, None])
    # An end has no edits left: where the slice ends, or the conversation does in a sound state.
    over = at_end[:, None] & (~last_row[:, None] | np.isin(state, ENDS))
    optimal &= ~over[:, :, None]
    target, optimal = target.reshape(-1, 4), optimal.reshape(-1, 4)
    nodes = np.arange(len(target))
    goes = optimal.any(1)
    rank = np.zeros(len(nodes), np.int64)
    key = np.where(optimal, np.arange(1, 5) * (len(nodes) + 1) + rank[target], np.iinfo(np.int64).max)
    choice = key.argmin(1)
    jump = np.where(goes, target[nodes, choice], nodes)
    rank = np.unique(np.where(goes, key[nodes, choice], 0), return_inverse=True)[1]
    jumps = [jump]
    while (jump[jump] != jump).any():
        rank = np.unique(rank * (len(nodes) + 1) + rank[jump], return_inverse=True)[1]
        jump = jump[jump]
        jumps.append(jump)
    letter = np.frombuffer(EDITS.encode(), np.uint8)[choice]
    to_assistant = np.isin(choice, (1, 3)) & (nodes % 4 == 2)
    return Paths(np.where(to_assistant, letter + 32, letter).astype(np.uint8), jumps, rank)


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def in_order(
    conversations: DataFrame, names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text")
) -> DataFrame:
    """``conv, turn, role, text, pos, fault``: the rows by conversation and turn, numbered.

    Ranges of rows are sorted apart, so a long conversation is spread over tasks. ``fault`` is
    the first of blank, duplicate and truncated that holds, or NULL.
    """
    conv, turn, role, text = names
    keys = ["conv", "turn", "role", "text"]
    rows = conversations.select(
        col(conv).alias("conv"), col(turn).alias("turn"),
        F.coalesce(col(role), F.lit(SPACE)).alias("role"),
        F.coalesce(col(text), F.lit(SPACE)).alias("text"),
    )
    said = [F.coalesce(F.col("conv").cast("string"), F.lit("")), F.col("conv").isNull(), "role", "text"]
    placed = cut(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("pos", F.monotonically_increasing_id())
        .withColumns({"k1": F.xxhash64(*said), "k2": F.xxhash64(F.lit(1), *said)})
    )
    first = (
        placed.groupBy("k1", "k2")
        .agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    bare = F.btrim("text", F.lit(WHITE))
    return placed.join(first, ["k1", "k2"], "left").select(
        *keys, "pos",
        F.when(bare == "", "blank")
        .when(F.col("pos") > F.col("first"), "duplicate")
        .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated")
        .alias("fault"),
    )


def _slices(placed: DataFrame, rows: int) -> DataFrame:
    """``conv, at, codes``: up to ``rows`` rows of a conversation, a letter each."""
    fault = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(
        F.col("fault") == "truncated", CUT_OFF
    ).otherwise(SOUND)
    return (
        placed.select(
            "conv", "pos", F.floor(F.col("pos") / rows).alias("slice"),
            F.char(65 + 3 * _initial(F.col("role")) + fault).alias("code"),
        )
        .groupBy("conv", "slice")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("rows"))
        .select(
            "conv", F.col("rows")[0]["pos"].alias("at"),
            F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"),
        )
    )


@dataclass
class Repair:
    """``rows``: the rows with their fault (``in_order``). ``summary``: ``conv, cost, illegal``.
    ``audits``: ``conv, at, edits``, the edits of each slice. ``edits``: ``conv, at, step, edit,
    turn, role, text``, role and text as they are after the edit; a deleted row keeps its own."""

    rows: DataFrame
    summary: DataFrame
    audits: DataFrame
    edits: DataFrame


def repair_conversations(
    conversations: DataFrame,
    names: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
    slice_rows: int = 4096,
) -> Repair:
    """The cheapest edits that leave an optional system turn, then pairs of user and assistant
    turns, or nothing; of equally cheap ones those whose initials, in order, are ASCII-least.

    Blank rows (nothing but white space) and duplicates (role and text stand earlier in the
    conversation) must be deleted; truncated rows (the last visible character is not ``.``, ``!``
    or ``?``) cost more unless they are. Roles count by their first character; one that is not
    s, u or a, or is empty, can't be kept.

    A conversation is cut into slices of ``slice_rows`` rows. Each slice gives the least costs
    between the states at its ends; from these, the costs behind each slice; with them each slice
    ranks its paths, for every state it can be entered in. So a conversation of any length is spread
    over tasks, and one task sees 16 numbers a slice of it.

    NULL roles and texts are one space. NULL turns come first; equal turns go by role, then text;
    repeated rows are duplicates; NULL is a conversation like others. An empty table gives empty
    frames; a conversation without rows is in none of them. Other columns are not looked at.
    """
    placed = cut(in_order(conversations, names))
    # A row of a slice is a letter, but much work: small partitions are not to be merged.
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = cut(_slices(placed, slice_rows).repartition(tasks, "at"))

    @F.pandas_udf("struct<costs:array<bigint>,illegal:bigint>")
    def measured(codes: pd.Series) -> pd.DataFrame:
        legal = {"su", "ua", "au"}
        initials = ["".join("suao"[(ord(c) - 65) // 3] for c in text) for text in codes]
        return pd.DataFrame({
            "costs": [between(c) for c in codes],
            "illegal": [sum(a + b not in legal for a, b in zip(x, x[1:])) for x in initials],
        })

    @F.pandas_udf("struct<cost:bigint,leave:array<array<bigint>>,illegal:bigint>")
    def behind(lists: pd.Series, borders: pd.Series) -> pd.DataFrame:
        out = []
        for costs, pairs in zip(lists, borders):
            ends = [0 if state in ENDS else FAR for state in range(4)]
            leave, cost = [ends], inserted(ends)
            for matrix in [np.asarray(m).reshape(4, 4) for m in costs][:0:-1]:
                # The last slice may also put turns in after its last row.
                leave.append([int(x) for x in (matrix + np.asarray(cost)).min(1)])
                cost = leave[-1]
            first = np.asarray(costs[0]).reshape(4, 4)
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
            out.append((int((first + np.asarray(cost)).min(1)[0]), leave[::-1], illegal))
        return pd.DataFrame(out, columns=["cost", "leave", "illegal"])

    first = F.substring("codes", 1, 1)
    last = F.substring("codes", -1, 1)

    def letter(code: Column) -> Column:
        return F.substring(F.lit("suao"), F.floor((F.ascii(code) - 65) / 3).cast("int") + 1, F.lit(1))

    by_conv = (
        slices.select("conv", "at", letter(first).alias("first"), letter(last).alias("last"),
                      measured("codes").alias("m"))
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("at", "first", "last", "m"))).alias("s"))
    )
    pairs = F.zip_with(
        F.slice("s", F.lit(1), F.size("s") - 1), F.slice("s", F.lit(2), F.size("s")),
        lambda a, b: F.array(a["last"], b["first"]),
    )
    known = cut(by_conv.select(
        "conv",
        F.transform("s", lambda x: x["at"]).alias("ats"),
        F.aggregate("s", F.lit(0).cast("long"), lambda n, x: n + x["m"]["illegal"]).alias("inside"),
        behind(F.transform("s", lambda x: x["m"]["costs"]), pairs).alias("b"),
    ))
    leaves = known.select(
        F.size("ats").alias("n"), F.posexplode(F.arrays_zip("ats", F.col("b.leave").alias("leave")))
        .alias("k", "x")
    ).select("x.ats", "x.leave", (F.col("k") == F.col("n") - 1).alias("last"))

    ways = "array<struct<end:int,edits:string>>"

    @F.pandas_udf(ways)
    def paths(codes: pd.Series, leave: pd.Series, last: pd.Series) -> pd.Series:
        codes = list(codes)
        found = rank_paths(codes, [list(map(int, x)) for x in leave], list(last))
        base, out = 0, []
        for text in codes:
            made = [found.audit(4 * base + state) for state in range(4)]
            out.append([{"end": end % 4, "edits": edits} for edits, end in made])
            base += len(text) + 1
        return pd.Series(out)

    tried = cut(
        slices.join(leaves, slices["at"] == leaves["ats"])
        .repartition(tasks, "at")
        .select("conv", "at", paths("codes", "leave", "last").alias("ways"))
    )

    @F.pandas_udf("array<int>")
    def entries(ends: pd.Series) -> pd.Series:
        out = []
        for conv in ends:
            state, own = 0, []
            for row in conv:
                own.append(state)
                state = int(row[state])
            out.append(own)
        return pd.Series(out)

    ends = F.transform("ways", lambda w: w["end"]).alias("ends")
    walked = (
        tried.select("conv", F.struct("at", ends).alias("s"))
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list("s")).alias("s"))
        .select(F.explode(F.arrays_zip(
            F.transform("s", lambda x: x["at"]).alias("e_at"),
            entries(F.transform("s", lambda x: x["ends"])).alias("entry"),
        )).alias("x"))
        .select("x.e_at", "x.entry")
    )
    audits = cut(
        tried.join(walked, tried["at"] == walked["e_at"])
        .select("conv", "at", F.element_at("ways", F.col("entry") + 1)["edits"].alias("edits"))
    )
    steps = audits.select("conv", "at", "edits", F.posexplode(F.split("edits", "")).alias("step", "edit"))
    used = F.char_length(F.translate(F.substring("edits", F.lit(1), F.col("step")), "Ii", ""))
    made = F.col("edit").isin("I", "i")
    # Inserted turns get numbers that no row has, each its own.
    numbered = steps.select(
        "conv", "at", "step", "edit",
        F.when(made, -1 - F.col("at") * 2 - F.col("step")).otherwise(F.col("at") + used).alias("pos"),
    )
    own = placed.select("pos", "turn", F.col("role").alias("old"), F.col("text").alias("said"))
    edits = numbered.join(own, "pos", "left").select(
        "conv", "at", "step", F.upper("edit").alias("edit"), "turn",
        F.when(F.col("edit").isin("R", "I"), "user").when(F.col("edit").isin("r", "i"), "assistant")
        .otherwise(F.col("old")).alias("role"),
        F.coalesce("said", F.lit("")).alias("text"),
    )
    summary = known.select("conv", "b.cost", (F.col("inside") + F.col("b.illegal")).alias("illegal"))
    return Repair(placed, summary, audits.withColumn("edits", F.upper("edits")), edits)


def digests(edits: DataFrame) -> DataFrame:
    """``conv, sha256`` of each conversation's repaired rows, written ``role:text`` and joined by
    line feeds. The rows of a conversation stream through one task in order; none are held."""
    kept = edits.where("edit <> 'D'").select(
        "conv", "at", "step", F.concat("role", F.lit(":"), "text").alias("line")
    )
    kind = kept.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, id_type = None, None, None

        def said(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], id_type), pa.array([r[1] for r in rows], pa.string())],
                names=["conv", "sha256"],
            )

        for batch in batches:
            id_type, done = batch.column("conv").type, []
            for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
                if digest is None or conv != now:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256(line.encode())
                else:
                    digest.update(b"\n" + line.encode())
            yield said(done)
        if digest is not None:
            yield said([(now, digest.hexdigest())])

    return (
        kept.repartition("conv").sortWithinPartitions("conv", "at", "step")
        .select("conv", "line").mapInArrow(run, f"conv {kind}, sha256 string")
    )

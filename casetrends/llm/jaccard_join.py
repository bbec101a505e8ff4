"""Texts of similar word sets, found by recursive splitting on sampled shared tokens."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrends.llm.common import col, cut, text_of, tidied, unused

UPPER_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

#: Groups up to this size are compared pair by pair; larger ones are split on.
SMALL = 256
#: Rows of one side when a group that cannot be split is compared block by block.
BLOCK = 256
#: Blocks of texts that are compared whole at most where nodes of much the same texts remain.
BLOCKS = 16
DEPTH = 5
#: A class beyond ``BLOCKS`` blocks has larger ones, up to this size, that a task compares piece by
#: piece: a text is sent to as many tasks as its class has blocks.
GRID = 4096
#: Tokens that a set samples on average at a node below the roots, at most.
SAMPLED = 2.25


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on all of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * ODD[1]
    x = (x ^ (x >> np.uint64(27))) * ODD[2]
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of hashed runs of ``width`` words; a text of fewer words, but not none, is one run."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def _word(self, word: bytes) -> int:
        import xxhash

        got = self.known.get(word)
        if got is None:
            if len(self.known) > 1 << 18:
                self.known.clear()
            got = self.known[word] = xxhash.xxh64_intdigest(word)
        return got

    def of(self, text: str) -> np.ndarray:
        words = WORDS.findall(text.encode("utf-8", "surrogatepass").translate(UPPER_BYTES))
        if not words:
            return np.zeros(0, np.uint64)
        hashed = np.fromiter(map(self._word, words), np.uint64, len(words))
        n = max(len(words) - self.width + 1, 1)
        out = np.full(n, np.uint64(len(words) if len(words) < self.width else 0))
        for k in range(min(self.width, len(words))):
            out = mix(out + ODD[0] + hashed[k : k + n])
        return np.unique(out)


def chosen(tokens: np.ndarray, path: np.uint64, share: float) -> np.ndarray:
    """The tokens that a set samples at a node, by a hash of both: 1 / ``share`` on average.

    Two sets of one node sample a shared token together unless it lies between their rates.
    """
    root = np.asarray([path], np.uint64)  # arrays wrap around without a warning
    drawn = mix(tokens ^ mix(root + ODD[0]))
    limit = np.uint64(min(1.0, 1.0 / (share * max(len(tokens), 1))) * (2**64 - 2**12))
    return mix(drawn[drawn <= limit] + root)


def plan_runs(target_recall: float, depth: int = DEPTH) -> tuple[int, float]:
    """Runs, and tokens sampled per node below the roots, that find a pair at the threshold with the
    target's chance even if all nodes it meets in are split at every level.

    A run keeps the pair together at the root with a chance of 1 - exp(-1), and at each level below
    with 1 - exp(-tokens).
    """
    root = 1 - math.exp(-1)
    runs = 1
    while True:
        below = ((1 - (1 - target_recall) ** (1 / runs)) / root) ** (1 / max(depth - 1, 1))
        if below < 1 and -math.log(1 - below) <= SAMPLED:
            return runs, max(1.0, -math.log(1 - below))
        runs += 1


def sort_groups(df: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of one key in one task, one after another."""
    return df.repartition(key).sortWithinPartitions(key, *order)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from sorted batches; only the last group is held back."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(key)
        last = column[-1]
        same = np.asarray(column.to_numpy(zero_copy_only=False) == last.as_py())
        start = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if held and (start > 0 or held[0].column(key)[-1].as_py() != last.as_py()):
            head = batch.slice(0, start)
            yield pa.Table.from_batches([*held, head] if start else held)
            held = [batch.slice(start)]
        elif start > 0:
            yield pa.Table.from_batches([batch.slice(0, start)])
            held = [batch.slice(start)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def similar_pairs(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """A matrix that is true where the Jaccard similarity of two sets reaches the threshold."""
    sizes = np.array([len(s) for s in sets], np.float64)
    _, inverse, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = often[inverse] > 1
    number = np.cumsum(often > 1) - 1
    rows, columns = rows[shared], number[inverse[shared]]
    common = np.zeros((len(sets), len(sets)))
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    step = 4096
    for a in range(0, int(often[often > 1].size), step):
        lo, hi = np.searchsorted(columns, [a, a + step])
        part = np.zeros((len(sets), step), np.float32)
        part[rows[lo:hi], columns[lo:hi] - a] = 1
        common += part @ part.T
    union = sizes[:, None] + sizes[None, :] - common
    with np.errstate(invalid="ignore", divide="ignore"):
        out = np.where(union > 0, common / union, 0.0) >= threshold
    np.fill_diagonal(out, False)
    return out


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Each row's first row of the same component."""
    root = np.full(len(links), -1)
    out = []
    for i in range(len(links)):
        if root[i] >= 0:
            continue
        root[i] = i
        todo = [i]
        while todo:
            for j in np.flatnonzero(links[todo.pop()] & (root < 0)):
                root[j] = i
                todo.append(int(j))
                out.append((int(j), i))
    return out


def text_key(text_col: str) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.md5(text_of(text_col)))


def _nodes(texts: DataFrame, width: int, share: float, runs: int) -> DataFrame:
    """``node, rec``: what each text samples at the root of each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingles(width)
        for batch in batches:
            source, nodes = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                tokens = make.of(text)
                for r in range(runs):
                    for node in chosen(tokens, np.uint64(r + 1), share):
                        source.append(i)
                        nodes.append(node)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(nodes, np.uint64).view(np.int64)),
                 batch.column("rec").take(pa.array(source, pa.int64()))],
                names=["node", "rec"],
            )

    return texts.mapInArrow(run, "node long, rec binary")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingles(width)
        for batch in batches:
            tokens = [make.of(text) for text in batch.column("text").to_pylist()]
            # The upper halves are as good a hash, and half as long to store and send.
            halves = [np.unique((t >> np.uint64(32)).astype("<u4")) for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rec"), pa.array([h.tobytes() for h in halves], pa.binary())],
                names=["rec", "tokens"],
            )

    return texts.mapInArrow(run, "rec binary, tokens binary")


def _descend(crowded: DataFrame, share: float) -> DataFrame:
    """``node, parent, rec``: the next tokens of the members of large nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, nodes, parents = [], [], []
            rows = zip(batch.column("node").to_pylist(), batch.column("tokens").to_pylist())
            for i, (parent, data) in enumerate(rows):
                tokens = mix(np.frombuffer(data, "<u4").astype(np.uint64))
                for node in chosen(tokens, np.asarray(parent, np.int64).view(np.uint64), share):
                    source.append(i)
                    nodes.append(node)
                    parents.append(parent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(nodes, np.uint64).view(np.int64)),
                 pa.array(parents, pa.int64()),
                 batch.column("rec").take(pa.array(source, pa.int64()))],
                names=["node", "parent", "rec"],
            )

    return crowded.mapInArrow(run, "node long, parent long, rec binary")


def _counted(nodes: DataFrame) -> DataFrame:
    """Size and fingerprint of each node that several texts share."""
    spread = [F.xxhash64("rec"), F.xxhash64(F.lit(1), "rec")]
    return (
        nodes.groupBy("node")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(spread[0]).alias("f1"),
            F.bit_xor(spread[1]).alias("f2"),
        )
        .where(F.col("size") > 1)
    )


def _groups(members: DataFrame, group: str) -> DataFrame:
    """``part, side, rec``: small groups whole, larger ones as pairs of blocks.

    ``members`` has the group's ``size``. A pair of blocks i < j gets both, side 0 and 1; a block
    meets itself once (i = j). So no task holds more than two blocks, of up to ``GRID`` texts.
    """
    block = F.least(F.lit(GRID), F.greatest(F.lit(BLOCK), F.ceil(F.col("size") / BLOCKS)))
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("rec"), blocks).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda k: F.struct(
            F.least(own, k).alias("i"), F.greatest(own, k).alias("j"),
            (own > k).cast("int").alias("side"),
        ),
    )
    return members.select(group, "rec", F.explode(pair).alias("p")).select(
        F.xxhash64(group, F.col("p.i"), F.col("p.j")).alias("part"),
        F.col("p.side").alias("side"),
        (F.col("p.i") == F.col("p.j")).alias("whole"),
        "rec",
    )


def _named(nodes: DataFrame) -> DataFrame:
    """``group, size, rec``: nodes of the same texts are one group."""
    return nodes.select(
        F.xxhash64("size", "f1", "f2").alias("group"), "size", "rec"
    ).distinct()


def _divided(named: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their ``root``; and ``group, main, strays`` of groups in several components.

    ``main`` is the component most of the group's texts are in, ``strays`` how many are not.
    """
    rooted = named.join(roots, "rec", "left").withColumn("root", F.coalesce("root", "rec"))
    sizes = rooted.groupBy("group", "root").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("group").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"),
        (F.sum("n") - F.max("n")).alias("strays"),
    )
    return rooted, split.where("strays > 0")


def _heads(named: DataFrame) -> DataFrame:
    """``rec, root``: for each text, the largest of its groups of up to ``BLOCKS`` blocks.

    Nodes of different runs hold much the same near copies. Where all texts of one head are
    compared, groups need only the pairs of texts with different heads.
    """
    best = F.max(F.struct("size", "group")).alias("best")
    fit = named.where(F.col("size") <= BLOCKS * BLOCK).groupBy("rec").agg(best)
    return fit.select("rec", F.unhex(F.hex("best.group")).alias("root"))


def _stray_parts(rooted: DataFrame, few: DataFrame) -> DataFrame:
    """``part, side, whole, rec``: the main component by blocks, all strays with each of them.

    Strays so meet every text of the group. They are two blocks at most, so the parts hold no
    more than three times the group's texts in all.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    stray = F.sequence(F.lit(0), blocks - 1)
    dealt = F.array(F.pmod(F.xxhash64("rec", "group"), blocks).cast("int"))
    return (
        rooted.join(few, "group")
        .withColumn("b", F.explode(F.when(F.col("root") == F.col("main"), dealt).otherwise(stray)))
        .select(
            F.xxhash64("group", F.lit(-1), "b").alias("part"), F.lit(0).alias("side"),
            F.lit(True).alias("whole"), "rec",
        )
    )


def _led_blocks(members: DataFrame) -> DataFrame:
    """``part, side, whole, rec``: large groups by blocks, each with the group's least text."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    # Another deal in each group, so that texts of one group in several meet others in each.
    dealt = F.pmod(F.xxhash64("rec", "group"), blocks).cast("int")
    own = members.select("group", dealt.alias("b"), "rec")
    leaders = members.groupBy("group").agg(F.min("rec").alias("rec"), F.first("size").alias("size"))
    led = leaders.select("group", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("b"), "rec")
    return own.unionByName(led).distinct().select(
        F.xxhash64("group", "b").alias("part"), F.lit(0).alias("side"), F.lit(True).alias("whole"),
        "rec",
    )


def block_links(
    sets: list[np.ndarray], side: np.ndarray, whole: bool, threshold: float
) -> Iterator[tuple[list[int], np.ndarray]]:
    """``rows, links`` of pieces of a part: each pair of its rows in one of them, or where it is a
    pair of blocks (not ``whole``), each pair of rows of different sides."""
    pieces = [
        rows[k : k + BLOCK]
        for own in ([np.arange(len(sets))] if whole else [np.flatnonzero(side == x) for x in (0, 1)])
        for rows in [own]
        for k in range(0, len(rows), BLOCK)
    ]
    if len(sets) <= 2 * BLOCK:
        links = similar_pairs(sets, threshold)
        if not whole:  # pairs of one block are another part's
            links &= side[:, None] != side[None, :]
        yield list(range(len(sets))), links
        return
    for i, first in enumerate(pieces):
        for j, second in enumerate(pieces[i:], i):
            if not whole and side[first[0]] == side[second[0]]:
                continue
            rows = first if i == j else np.concatenate([first, second])
            links = similar_pairs([sets[k] for k in rows], threshold)
            if i != j:  # pairs inside a piece are found where it meets itself
                part = np.arange(len(rows)) < len(first)
                links &= part[:, None] != part[None, :]
            yield rows.tolist(), links


def _compare(parts: DataFrame, sets: DataFrame, threshold: float, count: bool) -> DataFrame:
    """Links inside each part: with ``count`` the number for each text, else a spanning forest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "part"):
            keys = table.column("part").to_numpy()
            recs, data = table.column("rec").to_pylist(), table.column("tokens").to_pylist()
            side, whole = table.column("side").to_numpy(), table.column("whole").to_pylist()
            ends = np.flatnonzero(np.diff(keys)) + 1
            out = []
            for a, b in zip([0, *ends], [*ends, len(keys)]):
                sets = [np.frombuffer(d, "<u4") for d in data[a:b]]
                found: dict[int, int] = {}
                for rows, links in block_links(sets, side[a:b], whole[a], threshold):
                    if count:
                        for i, n in zip(rows, links.sum(axis=1)):
                            found[i] = found.get(i, 0) + int(n)
                    else:
                        out += [(recs[a + rows[i]], recs[a + rows[j]]) for i, j in _forest(links)]
                out += [(recs[a + i], n) for i, n in found.items() if n]
            second = pa.int64() if count else pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.binary()), pa.array([y for _, y in out], second)],
                names=["rec", "links" if count else "other"],
            )

    schema = "rec binary, " + ("links long" if count else "other binary")
    return sort_groups(parts.join(sets, "rec"), "part").mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """``rec, root``: every text of the edges with the least text of its component.

    Each round points the greater neighbours of a text at its least one, then its smaller ones,
    until nothing changes. Grouping takes minima only, so a text of many neighbours is no load.
    """

    def state(df: DataFrame) -> tuple:
        both = F.xxhash64("u", "v")
        row = df.agg(F.count(F.lit(1)), F.bit_xor(both), F.bit_xor(F.xxhash64(F.lit(1), "u", "v")))
        return tuple(row.first())

    now = cut(
        edges.select(F.greatest("rec", "other").alias("u"), F.least("rec", "other").alias("v"))
        .where("u != v")
        .distinct()
    )
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut(large.where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                    F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        now = cut(small)
        after = state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("rec"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("rec"), F.col("v").alias("root")).distinct()
    )


def _connected(
    keyed: DataFrame, threshold: float, width: int, target_recall: float
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored: the texts (``rec, least, n_copies``), sets of those that meet another, and their
    components (``rec, root``)."""
    runs, sampled = plan_runs(target_recall)
    first = cut(keyed.groupBy("rec").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n_copies")))
    texts = keyed.select("rec", "text")

    # Counted and joined through one shuffle, which holds the nodes as long as both need them.
    level = _nodes(texts, width, threshold, runs).distinct()
    met = cut(level.join(_counted(level), "node"))
    # Equal texts are equal rows here; one of each is kept where the join has put it.
    wanted = texts.join(met.select("rec").distinct(), "rec", "left_semi")
    sets = cut(_sets(wanted.groupBy("rec").agg(F.first("text").alias("text")), width))
    crowded = met.where(F.col("size") > SMALL).withColumn("group", F.xxhash64("size", "f1", "f2"))
    parts = _groups(_named(met.where(F.col("size") <= SMALL)), "group")
    if not crowded.isEmpty():
        parts = parts.unionByName(_led_blocks(_named(crowded)))
    edges = cut(_compare(parts, sets, threshold, count=False))
    roots = components(edges)
    leaves, more = [], []
    for level in range(2, DEPTH + 2):
        # A large node that is one component by now can connect nothing more. One with few texts
        # outside its main component is compared at once; the others are split on.
        named = _named(crowded)
        rooted, split = _divided(named, roots)
        split = cut(split)
        if split.isEmpty():
            break
        more.append(_stray_parts(rooted, split.where(F.col("strays") <= BLOCK)))
        many = split.where(F.col("strays") > BLOCK).select("group")
        if level > DEPTH:  # what is still together is compared whole, in pairs of blocks
            more.append(_groups(named.join(many, "group", "left_semi"), "group"))
            break
        # A node still large after a split holds texts that much the same nodes hold. So does, before
        # any split, one of texts of which half the nodes are large.
        still = cut(named.join(many, "group", "left_semi"))
        if not still.isEmpty():
            alike = still
            if level == 2:
                often = crowded.groupBy("rec").agg(F.count(F.lit(1)).alias("n"))
                alike = still.join(often.where(F.col("n") >= runs / 2), "rec", "left_semi")
            heads = cut(_heads(alike))
            sizes = heads.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
            own = heads.join(sizes, "root").withColumn("group", F.xxhash64(F.lit(-2), "root"))
            more.append(_groups(own, "group"))
            headed, split = _divided(still, heads)
            split = cut(split)
            more.append(_stray_parts(headed, split.where(F.col("strays") <= 2 * BLOCK)))
            many = split.where(F.col("strays") > 2 * BLOCK).select("group")
        crowded = cut(crowded.join(many, "group", "left_semi"))
        if crowded.isEmpty():
            break
        below = cut(_descend(crowded.join(sets, "rec"), threshold / sampled).select("node", "rec").distinct())
        met = cut(below.join(_counted(below), "node"))
        leaves.append(met.where(F.col("size") <= SMALL))
        crowded = met.where(F.col("size") > SMALL).withColumn("group", F.xxhash64("size", "f1", "f2"))
    if leaves:
        more.append(_groups(_named(reduce(DataFrame.unionByName, leaves)), "group"))
    if more:
        parts = reduce(DataFrame.unionByName, more).distinct()
        edges = edges.unionByName(cut(_compare(parts, sets, threshold, count=False)))
        roots = components(edges)

    return first, sets, roots


def similar_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.8,
    width: int = 5,
    target_recall: float = 0.99,
) -> DataFrame:
    """``id, rec, class_id, n_links, n_copies`` for every row.

    Two texts are linked when the sets of their runs of ``width`` lower-cased words have a Jaccard
    similarity of ``threshold`` or more. Classes are what links and equal texts connect;
    ``class_id`` is the least id of the class, ``n_links`` the number of other texts linked to
    this one, ``n_copies`` that of rows with this very text (``rec`` is its hash).

    Chosen-path join: at a node, every set samples about 1 / ``threshold`` of its tokens by a hash
    of node and token, and goes on to their nodes; so two similar sets meet again in each level
    with the share of tokens they have in common. Nodes of up to ``SMALL`` texts are compared pair
    by pair, larger ones are split again, ``DEPTH`` levels at most; what is still together is
    compared whole, in pairs of blocks. A large node of which all texts but a few are connected
    already is not split: the few are compared with all of it. Of texts that meet much the same
    others in most of their nodes (half of the roots, all nodes after a split), each one's
    largest node of up to ``BLOCKS`` blocks is compared whole, other nodes then need only pairs of
    texts with different largest nodes. Runs are repeated until a pair just at the threshold is met
    with a chance of ``target_recall``, at the last level as at the first (``plan_runs``). Links of a
    class are counted by comparing all its texts, so the join has to find only what connects it.
    Sets are compared by 32 bits of each run's hash: two different runs of a pair of texts of a
    thousand words share one by a chance of 1 in 4000, which moves its similarity by a thousandth.

    NULL text is empty; texts without words are linked to nothing, but are copies of each other.
    NULL ids are carried along and are nobody's least id unless a class has no other. Repeated
    rows all come back; an empty table gives no rows.
    """
    keyed = docs.select(col(id_col).alias("id"), text_key(text_col).alias("rec"),
                        text_of(text_col).alias("text"))
    with tidied(docs.sparkSession):
        first, sets, roots = _connected(keyed, threshold, width, target_recall)

    members = roots.join(roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "root")
    numbered = members.withColumn("group", F.xxhash64("root"))
    links = (
        _compare(_groups(numbered, "group"), sets, threshold, count=True)
        .groupBy("rec")
        .agg(F.sum("links").alias("n_links"))
    )
    classes = (
        first.join(roots, "rec", "left")
        .join(links, "rec", "left")
        .withColumn("root", F.coalesce("root", "rec"))
    )
    least = classes.groupBy("root").agg(F.min("least").alias("class_id"))
    known = classes.join(least, "root").select(
        "rec", "class_id", "root", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "n_copies",
    )
    return keyed.select("id", "rec").join(known, "rec")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents with the least id of their class, one row of each, with their columns as
    they are; of rows that repeat id and text, one."""
    found = similar_texts(docs, id_col, text_col, **how)
    best = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rec")).alias("best")
    ).select(F.col("best.id").alias("id"), F.col("best.rec").alias("rec"))
    (rec,) = unused(docs, "rec")
    keyed = docs.withColumn(rec, text_key(text_col))
    kept = keyed.join(best.withColumnRenamed("rec", "best_rec").withColumnRenamed("id", "best_id"),
                      (F.col("best_rec") == col(rec)) & F.col("best_id").eqNullSafe(col(id_col)),
                      "left_semi")
    return kept.dropDuplicates([rec]).select(*[col(c) for c in docs.columns])



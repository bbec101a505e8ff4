"""Shards by jump consistent hashing, and gapless places in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrends.llm.common import col, cut, text_of

# The multiplier of the generator in the published algorithm, by 32-bit halves.
STEP = 2862933555777941757
STEP_HIGH, STEP_LOW = STEP >> 32, STEP & 0xFFFFFFFF
LOW = 0xFFFFFFFF


def _low(x: Column, bits: int) -> Column:
    return x.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _times_step(high: Column, low: Column) -> tuple[Column, Column]:
    """``key * STEP + 1`` modulo 2^64, on 32-bit halves so that nothing overflows."""
    step_low, step_high = (F.lit(n).cast("long") for n in (STEP_LOW, STEP_HIGH))
    first = _low(low, 16) * step_low + 1
    second = F.shiftright(low, 16) * step_low
    below = first + F.shiftleft(_low(second, 16), 16)
    cross = (
        _low(low * step_high, 32)
        + _low(_low(high, 16) * step_low, 32)
        + F.shiftleft(_low(F.shiftright(high, 16) * step_low, 16), 16)
    )
    carry = F.shiftright(below, 32) + F.shiftright(second, 16)
    return _low(cross + carry, 32), _low(below, 32)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key, 0 to ``shards`` - 1, by the published loop.

    Each round jumps to a greater shard, so ``shards`` rounds are enough; those after the last
    jump change nothing.
    """

    def start() -> Column:
        return F.struct(
            F.shiftrightunsigned(key, 32).alias("high"),
            _low(key, 32).alias("low"),
            F.lit(0).cast("long").alias("at"),
            F.lit(0).cast("long").alias("jump"),
        )

    def step(s: Column, _: Column) -> Column:
        high, low = _times_step(s["high"], s["low"])
        ratio = F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")
        ahead = F.floor((s["jump"] + 1).cast("double") * ratio).cast("long")
        return F.when(s["jump"] >= shards, s).otherwise(
            F.struct(
                high.alias("high"), low.alias("low"), s["jump"].alias("at"), ahead.alias("jump")
            )
        )

    rounds = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(rounds, start(), step, lambda s: s["at"].cast("int"))


def stable_key(docs: DataFrame, id_col: str) -> Column:
    """Whole numbers are their own key, other ids are hashed; NULL is key 0."""
    kind = docs.schema[id_col].dataType
    whole = isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    key = col(id_col).cast("long") if whole else F.xxhash64(col(id_col).cast("string"))
    return F.when(col(id_col).isNotNull(), key).otherwise(F.lit(0).cast("long"))


def assign_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16
) -> DataFrame:
    """``id, size, text_crc32, shard, slot, grown_shard`` of every document.

    The id alone decides the shard; ``grown_shard`` is the one among ``shards`` + 1, which equals
    it or is the new shard. Slots count from 0 without gaps by id (NULL first), then checksum and
    size; rows equal in all of them have any order. ``size`` is the UTF-8 length plus 1.

    NULL text has no bytes; NULL ids share the shard of key 0; repeated rows get a slot each; an
    empty table gives no rows; other columns are not looked at.
    """
    key, text = stable_key(docs, id_col), text_of(text_col)
    rows = docs.select(
        col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        jump_hash(key, shards).alias("shard"),
        jump_hash(key, shards + 1).alias("grown_shard"),
    )
    # Ranges over (shard, id, ...) split a shard into as many tasks as it needs. Numbers by task
    # then become places by adding what the earlier tasks hold of the shard. The stored rows keep
    # their task, whatever is computed again.
    order = ["shard", "id", "text_crc32", "size"]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = cut(
        dealt.repartitionByRange(*order, "tie")
        .sortWithinPartitions(*order, "tie")
        .drop("tie")
        .withColumn("place", F.monotonically_increasing_id())
    )
    task = F.shiftright("place", 33)
    blocks = ranged.groupBy("shard", task.alias("task")).agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = blocks.select(
        "shard",
        "task",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    # One row for each task and shard boundary: a few thousand, whatever the rows are.
    return (
        ranged.withColumn("task", task)
        .join(F.broadcast(offsets), ["shard", "task"])
        .select(
            "id", "size", "text_crc32", "shard",
            (F.col("place") + F.col("shift")).alias("slot"),
            "grown_shard",
        )
    )

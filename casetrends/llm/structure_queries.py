"""Balanced packing and structure repair over their whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrends.llm import balanced_packing, structure_repair
from casetrends.llm.common import WHITE
from casetrends.llm.registry import query, table


@query("op11_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = os.environ.get("WORD_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")
    return balanced_packing.pack_balanced(table(spark, sf_dir, "documents"), path).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that the hash of conversation and turn deals out."""

    def filled(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(structure_repair.SPACE))

    fate = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    return (
        conversations.withColumn("fate", fate)
        .where("fate <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("fate") == 4, "user").otherwise(filled("role")).alias("role"),
            F.when(F.col("fate") == 1, "")
            .when(F.col("fate") == 2, F.translate(filled("text"), ".!?", ""))
            .otherwise(filled("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))),
        )
        .drop("col")
    )


REPAIR_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _least_sql(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _edit_sql(state: str, cost: str, letter: str, line: str | None = None) -> str:
    kept = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {kept}}}"


def _insert_sql(tail: str = "") -> str:
    """States after turns were put in."""
    two = _least_sql("s2", *(_edit_sql(f"s{k}", "5", "I", "'user:'") for k in (0, 1, 3)))
    three = _edit_sql("p2", "5", "I", "'assistant:'")
    return f"""SELECT * EXCLUDE (s2, s3), p2 AS s2, {_least_sql("s3", three)} AS s3
    FROM (SELECT *, {two} AS p2 FROM {tail})"""


CRC_SQL = """xor(list_reduce(
           list_prepend(4294967295, list_transform(
             regexp_extract_all(hex(encode({})), '..'), lambda h: CAST('0x' || h AS BIGINT))),
           lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])), 4294967295)"""

USER = [_edit_sql(f"s{k}", "1 + more", "R", "'user:' || text") for k in (0, 1, 3)]
KEPT = "role || ':' || text"
KEEP_USER = [_edit_sql(f"s{k}", "more", "K", KEPT) for k in (0, 1, 3)]


@query(
    "op12_structure_repair",
    f"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC_SQL.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate
  FROM conversations, t
), rows AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM raw WHERE fate <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         trim(text, {" || ".join(f"chr({ord(c)})" for c in WHITE)}) AS bare
  FROM rows
), faulty AS (
  SELECT conv_id, turn, k, role, text, left(role, 1) AS i,
         CASE WHEN bare = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1
              THEN 'duplicate'
              WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY k), 1) AS i0
  FROM placed
), walk AS (
  SELECT DISTINCT conv_id, CAST(1 AS BIGINT) AS k,
         {{'c': 0, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s0,
         {{'c': 1000000, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s1,
         {{'c': 1000000, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s2,
         {{'c': 1000000, 'a': '', 't': CAST([] AS VARCHAR[])}} AS s3
  FROM faulty
  UNION ALL
  SELECT conv_id, k + 1, {_edit_sql("s0", "2", "D")},
         {_least_sql(_edit_sql("s1", "2", "D"), "CASE WHEN stays AND i = 's' THEN " + _edit_sql("s0", "more", "K", KEPT) + " END")},
         {_least_sql(_edit_sql("s2", "2", "D"), *(f"CASE WHEN stays THEN {x} END" for x in USER), *(f"CASE WHEN stays AND i = 'u' THEN {x} END" for x in KEEP_USER))},
         {_least_sql(_edit_sql("s3", "2", "D"), "CASE WHEN stays THEN " + _edit_sql("s2", "1 + more", "R", "'assistant:' || text") + " END", "CASE WHEN stays AND i = 'a' THEN " + _edit_sql("s2", "more", "K", KEPT) + " END")}
  FROM ({_insert_sql('''(
      SELECT w.*, role, text, i, fault NOT IN ('blank', 'duplicate') AS stays,
             CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more
      FROM walk w JOIN faulty f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.k = f.k)''')})
), ended AS (
  SELECT conv_id, {_least_sql("s0", "s3")} AS s FROM ({_insert_sql('''(
    SELECT w.* FROM walk w JOIN (SELECT conv_id, max(k) AS n FROM faulty GROUP BY conv_id) f
    ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.k = n + 1)''')})
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i0 || i NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(s.c, 0) AS BIGINT) AS cost,
       coalesce(s.a, '') AS audit,
       sha256(coalesce(array_to_string(s.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(conversations, structure_repair.repair_conversations(damaged(conversations)))


def repair_report(conversations: DataFrame, found: structure_repair.Repair) -> DataFrame:
    """A row for every conversation of the table: counts, the audit and a digest of the result."""
    counts = found.rows.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == x).alias(x) for x in ("blank", "duplicate", "truncated")],
    )
    audits = found.audits.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("at", "edits"))).alias("parts")
    ).select("conv", F.array_join(F.transform("parts", lambda p: p["edits"]), "").alias("audit"))
    # All say something of a conversation, so one grouping puts them together; NULL is a key there.
    parts = [
        conversations.select(F.col("conv_id").alias("conv")).distinct(), counts, found.summary,
        audits, structure_repair.digests(found.edits),
    ]
    said = parts[0]
    for part in parts[1:]:
        said = said.unionByName(part, allowMissingColumns=True)
    return said.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in REPAIR_COUNTS],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )

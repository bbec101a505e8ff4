"""Each operator over its whole table, next to the SQL that gives the same rows."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrends.llm import chat, decontamination, jaccard_join, langid, licenses, line_dedup
from casetrends.llm import packing, quality, secret_scan, sharding
from casetrends.llm.common import UPPER, WHITE
from casetrends.llm.registry import query, table

LOWER_SQL = f"translate({{}}, '{UPPER}', '{UPPER.lower()}')"
WHITE_SQL = " || ".join(f"chr({ord(c)})" for c in WHITE)
WORDS_SQL = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def words_sql(text: str) -> str:
    return WORDS_SQL.format(LOWER_SQL.format(f"coalesce({text}, '')"))


OP1_SQL = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM {{docs}}
), lines AS (
  SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM rows
), keyed AS (
  SELECT *, {LOWER_SQL.format(f"trim(line, {WHITE_SQL})")} AS key FROM lines
), shared AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT r, pos, line, coalesce(k.doc_id <> s.owner, false) AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
), made AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY r
)"""


@query(
    "op1_line_dedup",
    OP1_SQL.format(docs="documents")
    + """
SELECT rows.doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256
FROM made JOIN rows ON made.r = rows.r""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def _spans_sql(kind: int, pattern: str, keep: str) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT r, {kind} AS kind, "end" - length(hit) AS start, "end" FROM (
    SELECT r, hit, value, sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY n) AS "end"
    FROM (
      SELECT r, unnest(list_slice(string_split_regex(text, '{pattern}'), 1, len(h))) AS gap,
             unnest(h) AS hit, unnest(v) AS value, generate_subscripts(h, 1) AS n
      FROM (
        SELECT r, text, regexp_extract_all(text, '{pattern}', 0) AS h,
               regexp_extract_all(text, '{pattern}', {1 if kind == 0 else 0}) AS v
        FROM rows
      )
    )
  ) WHERE {keep}"""


REACH = 300
MIXED = (
    f"length(value) = {secret_scan.KEY_CHARS} AND regexp_matches(value, '[a-z]')"
    " AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[0-9]')"
)


@query(
    "op2_secret_scans",
    f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), found AS (
  {" UNION ALL ".join((
      _spans_sql(0, secret_scan.ASSIGN, f"length(value) >= {secret_scan.ASSIGN_CHARS}"),
      _spans_sql(1, secret_scan.ACCESS, "true"),
      _spans_sql(2, secret_scan.HEX, "true"),
      _spans_sql(3, secret_scan.KEY_PART, MIXED),
      _spans_sql(4, secret_scan.ENDPOINT, "true"),
  ))}
), keys AS (
  SELECT * FROM found w WHERE kind = 3 AND EXISTS (
    SELECT 1 FROM found a WHERE a.r = w.r AND a.kind = 1 AND abs(a.start - w.start) <= {REACH})
), secret AS (
  SELECT r, start FROM keys UNION ALL SELECT r, start FROM found WHERE kind = 0
), ends AS (
  SELECT * FROM found w WHERE kind = 4 AND EXISTS (
    SELECT 1 FROM found a WHERE a.r = w.r AND a.kind = 1 AND abs(a.start - w.start) <= {REACH})
  AND EXISTS (SELECT 1 FROM secret a WHERE a.r = w.r AND abs(a.start - w.start) <= {REACH})
), spans AS (
  SELECT * FROM found WHERE kind <= 2 UNION ALL SELECT * FROM keys UNION ALL SELECT * FROM ends
), named AS (
  SELECT r, kind, start, {list(secret_scan.KINDS)!r}[kind + 1] || ':' || start || ':' || "end" AS said
  FROM spans
)
SELECT doc_id,
       count(*) FILTER (WHERE kind = 0) AS n_assign,
       count(*) FILTER (WHERE kind = 1) AS n_access,
       count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(said, ',' ORDER BY start, kind) FILTER (WHERE kind <= 2), ''))
         AS base_sha256,
       coalesce(string_agg(said, ',' ORDER BY start, kind), '') AS spans
FROM rows LEFT JOIN named ON rows.r = named.r
GROUP BY rows.r, doc_id""",
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(table(spark, sf_dir, "documents"), reach=REACH)

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


OP3_SQL = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, {words_sql("text")} AS words FROM {{docs}}
), item AS (
  SELECT item_id, words, least(len(words), 13) AS l
  FROM (SELECT item_id, {words_sql("text")} AS words FROM benchmark) WHERE len(words) > 0
), gram AS (
  SELECT DISTINCT item_id, l, array_to_string(words[i : i + l - 1], ' ') AS gram
  FROM (SELECT item_id, words, l, unnest(range(1, len(words) - l + 2)) AS i FROM item)
), window_ AS (
  SELECT r, l, i, array_to_string(words[i : i + l - 1], ' ') AS gram
  FROM (SELECT r, words, l, unnest(range(1, len(words) - l + 2)) AS i
        FROM rows, (SELECT DISTINCT l FROM gram))
), hit AS (
  SELECT r, w.l, i, item_id FROM window_ w JOIN gram g ON w.l = g.l AND w.gram = g.gram
), word AS (
  SELECT r, count(DISTINCT i + k) AS n_hit
  FROM (SELECT r, i, unnest(range(0, l)) AS k FROM (SELECT DISTINCT r, i, l FROM hit)) GROUP BY r
), items AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r
), judged AS (
  SELECT rows.r, doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
         coalesce(n, 0) AS n_items, coalesce(ids, '') AS ids,
         coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
  FROM rows LEFT JOIN word USING (r) LEFT JOIN items USING (r)
)"""


@query(
    "op3_benchmark_decontamination",
    OP3_SQL.format(docs="documents")
    + """
SELECT doc_id, n_words, n_hit, n_items, sha256(ids) AS items_sha256, contaminated FROM judged""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return (
        found.select(
            F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"),
            F.col("id").alias("doc_id"),
            "n_words",
            decontamination.covered(F.col("spans")).alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        )
        .withColumn(
            "contaminated", decontamination.contaminated(F.col("n_hit"), F.col("n_words"))
        )
        .drop("copy")
    )


@query(
    "op4_sharding",
    f"""
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), rows AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         xor(list_reduce(
           list_prepend(4294967295, list_transform(
             regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
             lambda h: CAST('0x' || h AS BIGINT))),
           lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])), 4294967295)
         AS text_crc32
  FROM documents, t
), walk AS (
  SELECT DISTINCT doc_id, CAST(coalesce(doc_id, 0) AS HUGEINT) AS key, CAST(0 AS BIGINT) AS j
  FROM rows
  UNION ALL
  SELECT doc_id, key, CAST(floor(CAST(j + 1 AS DOUBLE)
         * (CAST(2147483648 AS DOUBLE) / CAST((key // 8589934592) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, j, (key * {sharding.STEP} + 1) % 18446744073709551616 AS key
        FROM walk WHERE j < 17)
), placed AS (
  SELECT doc_id, CAST(max(j) FILTER (WHERE j < 16) AS INTEGER) AS shard,
         CAST(max(j) FILTER (WHERE j < 17) AS INTEGER) AS grown_shard
  FROM walk GROUP BY doc_id
)
SELECT rows.doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard
         ORDER BY rows.doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       grown_shard
FROM rows JOIN placed ON rows.doc_id IS NOT DISTINCT FROM placed.doc_id""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), shards=16).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"),
        "shard", "slot", "grown_shard",
    )


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.quality_report(docs, name="q")
    failed = (F.col("q.n_words") < 10) | (100 * F.col("q.n_repeat_words") > 20 * F.col("q.n_words"))
    return judged.select(
        "doc_id",
        *[F.col(f"q.{c}").alias(c) for c in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        failed.alias("base_failed"),
        (~failed & F.col("q.rejected_by").isNull()).alias("kept"),
    )


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang",
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2)
        .alias("held_out"),
    )
    models = langid.fit_models(docs.where(~F.col("held_out")))
    return langid.predict(docs, models, "text", "found").select(
        "doc_id", "held_out",
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.accepted").alias("accepted"),
    )


@query("op7_ngram_jaccard_join")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_texts(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies"
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query("op8_chat_formatting")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(
        [(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    said = chat.read_back(chat.format_windows(turns.unionByName(own)))
    parts = F.sort_array(
        F.collect_list(F.struct("segment", "window", "turns", "loss_text"))
    ).alias("parts")
    whole = said.groupBy("conv").agg(
        parts,
        F.sum("n_turns").alias("n_turns"),
        F.sum(F.char_length("loss_text")).alias("loss_chars"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.count(F.lit(1)).alias("n_windows"),
    )

    def digest(name: str):
        return F.sha2(F.array_join(F.transform("parts", lambda p: p[name]), ""), 256)

    return whole.select(
        F.col("conv").alias("conv_id"), "n_turns", digest("turns").alias("turns_sha256"),
        F.col("loss_chars").cast("long").alias("loss_chars"),
        digest("loss_text").alias("loss_sha256"), "formatted_chars", "n_windows",
    )


def tokenizer() -> dict:
    """The vocabulary's rank file and pattern; ``TOKENIZER_RANKS`` names another rank file."""
    import public_tokenizers

    return {
        "ranks_path": os.environ.get("TOKENIZER_RANKS")
        or public_tokenizers.path("byte_bpe_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
        "tokenizer_path": public_tokenizers.path("byte_bpe_50k.json"),
    }


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, **tokenizer()).select(
        F.col("id").alias("doc_id"), "piece", "start", "length",
        F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset",
    )


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def _templates_sql() -> str:
    return ", ".join(
        f"({k}, '{name}', '{text}')"
        for k, (name, text) in enumerate(licenses.TEMPLATES)
        if "'" not in text
    )


def _pairs_sql(source: str, keys: str) -> str:
    """Word pairs, numbered where they repeat."""
    return f"""
  SELECT {keys}, n, p, row_number() OVER (PARTITION BY {keys}, p) AS k FROM (
    SELECT {keys}, len(words) - 1 AS n,
           unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
             AS p
    FROM {source} WHERE len(words) > 1)"""


@query(
    "op10_license_scans",
    f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), unit AS (
  SELECT DISTINCT r, unit, {words_sql("unit")} AS words FROM (
    SELECT r, text AS unit FROM rows
    UNION SELECT r, unnest(string_split_regex(text, '{licenses.PARAGRAPH}')) FROM rows
    UNION SELECT r, unnest(string_split(text, chr(10))) FROM rows)
), template AS (
  SELECT t, license, {words_sql("text")} AS words
  FROM (VALUES {_templates_sql()}) v(t, license, text)
), up AS ({_pairs_sql("unit", "r, unit")}
), tp AS ({_pairs_sql("template", "t, license")}
), score AS (
  SELECT r, unit, license, CAST(2 * count(*) AS DOUBLE) / (any_value(up.n) + any_value(tp.n)) AS d
  FROM up JOIN tp ON up.p = tp.p AND up.k = tp.k GROUP BY r, unit, license, t
), best AS (
  SELECT r, unit, license, max(d) AS d FROM score WHERE d >= 0.8 GROUP BY r, unit, license
), by_doc AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         max(d) AS d
  FROM best GROUP BY r
)
SELECT doc_id, coalesce(n, 0) AS n_matches, coalesce(licenses, '') AS licenses, d AS best_dice
FROM rows LEFT JOIN by_doc ON rows.r = by_doc.r""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(
            F.sort_array(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ","
        ).alias("licenses"),
        F.array_max(F.transform("matches", lambda m: m["dice"])).alias("best_dice"),
    )

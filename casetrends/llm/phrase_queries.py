"""Phrase mining over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casetrends.llm import phrases
from casetrends.llm.common import UPPER
from casetrends.llm.registry import query, table

TOP = 2000


@query(
    "op13_phrase_collocations",
    f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), numbered AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words
  FROM pieces
), word AS (
  SELECT lang, p, generate_subscripts(words, 1) AS i, unnest(words) AS w1 FROM numbered
), grams AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4
  FROM word WINDOW o AS (PARTITION BY p ORDER BY i)
), f AS (
  SELECT lang, words, len(words) AS m, count(*) AS a FROM (
    SELECT lang, [w1] AS words FROM grams
    UNION ALL SELECT lang, [w1, w2] FROM grams WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3] FROM grams WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, [w1, w2, w3, w4] FROM grams WHERE w4 IS NOT NULL)
  GROUP BY lang, words HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.words, c.m, c.a, k, l.a AS l, r.a AS r,
         CAST(2000000 * CAST(c.a AS HUGEINT) // (l.a + r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
  JOIN f l ON l.lang = c.lang AND l.words = c.words[:k]
  JOIN f r ON r.lang = c.lang AND r.words = c.words[k + 1:]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), inner_ AS (
  SELECT lang, inner_words, max(a) AS most FROM (
    SELECT lang, a, unnest([words[1:2], words[2:3], words[3:4], words[1:3], words[2:4]]) AS inner_words, m
    FROM f WHERE m > 2)
  WHERE len(inner_words) BETWEEN 2 AND m - 1 GROUP BY lang, inner_words
), ranked AS (
  SELECT b.lang, array_to_string(words, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank
  FROM best b LEFT JOIN inner_ i ON b.lang = i.lang AND b.words = i.inner_words
  WHERE most IS NULL OR 100 * CAST(most AS HUGEINT) < 80 * CAST(a AS HUGEINT)
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN (SELECT lang, count(*) AS n FROM word GROUP BY lang) t ON ranked.lang = t.lang
WHERE rank <= {TOP}""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, n = phrases.mine_phrases(table(spark, sf_dir, "documents"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        found.where("NOT covered").withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= TOP)
    )
    return ranked.join(n.withColumnRenamed("lang", "n_lang"), F.col("lang") == F.col("n_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )

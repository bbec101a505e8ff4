"""License notices found by the Dice coefficient of word pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casetrends.llm.common import col, row_key, text_of, word_array

# Notices as licensors publish them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        'all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", '
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
)

# Blank lines end a paragraph.
PARAGRAPH = r"\n[\x20\x09\x0B-\x0D]*(?:\n[\x20\x09\x0B-\x0D]*)+"


def pairs(words: Column) -> Column:
    """Hashes of the word pairs; a pair's later occurrences are numbered, so sets count them all."""
    plain = F.sort_array(
        F.transform(
            F.sequence(F.lit(1), F.size(words) - 1),
            lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1)),
        )
    )

    def numbered(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) == F.size(found), found).otherwise(
            F.transform(
                found,
                lambda x, i: F.when(i == F.array_position(found, x) - 1, x).otherwise(
                    F.xxhash64(x, i - F.array_position(found, x).cast("int"))
                ),
            )
        )

    # The array is a variable of the outer function, so that it is made once.
    return F.element_at(F.transform(F.array(plain), numbered), 1)


def template_pairs(
    spark: SparkSession, templates: tuple[tuple[str, str], ...], threshold: float
) -> DataFrame:
    """``size, license, template, t_size, t_pairs``: a row for each template and each number of
    pairs that a text may have to reach ``threshold`` with it."""
    rows = [(k, name, text) for k, (name, text) in enumerate(templates)]
    words = spark.createDataFrame(rows, "template int, license string, text string").select(
        "template", "license", word_array(F.col("text")).alias("words")
    )
    n = F.size("words") - 1
    low = F.ceil(n * threshold / (2 - threshold) - 1e-9).cast("int")
    high = F.floor(n * (2 - threshold) / threshold + 1e-9).cast("int")
    made = words.where(n > 0).select(
        "license", "template", n.alias("t_size"), pairs(F.col("words")).alias("t_pairs"),
        low.alias("low"), high.alias("high"),
    )
    return made.select(
        F.explode(F.sequence("low", "high")).alias("size"),
        "license", "template", "t_size", "t_pairs",
    )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """``id, matches`` for every row; matches are sorted structs ``(unit, license, dice)``.

    Units are the whole text (0), then its paragraphs and lines in turn, counted on; a unit like
    an earlier one is left out. Words are lower-cased runs of digits, letters and whatever is not
    ASCII. Dice is twice the shared word pairs by the pairs of both sides, repeated pairs
    counted. A template is compared only with units whose number of pairs can reach the
    threshold. Of the templates of one license the best counts.

    NULL text and units of less than two words match nothing. NULL ids are carried along, a
    repeated row comes back as often as it is there. An empty table gives no rows.
    """
    sizes = template_pairs(docs.sparkSession, templates, threshold)
    text = text_of(text_col)
    units = F.array_distinct(
        F.concat(F.array(text), F.split(text, PARAGRAPH), F.split(text, "\n"))
    )
    own = F.array(F.lit(None).cast("string"))  # stands for the row itself, at place 0
    parts = docs.select(
        col(id_col).alias("id"),
        *row_key(id_col, text_col),
        F.posexplode(F.concat(own, units)).alias("unit", "part"),
    ).select("id", "k1", "k2", "unit", word_array(F.col("part")).alias("words"))
    # A few templates times a few hundred sizes, whatever the documents are.
    sized = parts.withColumn("size", F.size("words") - 1)
    known = sizes.select("size").distinct().withColumn("able", F.lit(True))
    able = (
        sized.join(F.broadcast(known), "size", "left")
        .where((F.col("unit") == 0) | F.col("able"))
        .select("id", "k1", "k2", "unit", "size",
                F.when(F.col("able"), pairs(F.col("words"))).alias("own"))
    )
    tried = able.join(F.broadcast(sizes), "size", "left")
    shared = F.size(F.array_intersect("own", "t_pairs"))
    dice = F.when(
        F.col("template").isNotNull(), 2 * shared / (F.col("size") + F.col("t_size"))
    )
    return (
        tried.select("id", "k1", "k2", "unit", "license", dice.alias("dice"))
        .where((F.col("unit") == 0) | (F.col("dice") >= threshold))
        .groupBy("k1", "k2", "unit", "license")
        .agg(F.first("id").alias("id"), F.max("dice").alias("dice"), F.count("*").alias("n"))
        .groupBy("k1", "k2")
        .agg(
            F.first("id").alias("id"),
            F.sum(F.when(F.col("unit") == 0, F.col("n"))).alias("n_rows"),
            F.collect_list(
                F.when(
                    F.col("unit") > 0,
                    F.struct((F.col("unit") - 1).alias("unit"), "license", "dice"),
                )
            ).alias("found"),
        )
        .select(
            "id",
            F.sort_array("found").alias("matches"),
            F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("copy"),
        )
        .drop("copy")
    )

"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import random

import pytest
from plain import CLASHES, classes, contamination, dedup_lines, documents, measures, words

from casetrends.llm.chat import escape, format_windows, read_back, unescape
from casetrends.llm.decontamination import (
    covered,
    find_contamination,
    remove_documents,
    remove_spans,
)
from casetrends.llm.jaccard_join import one_of_each_class, similar_texts
from casetrends.llm.langid import fit_models, predict
from casetrends.llm.licenses import scan_licenses
from casetrends.llm.line_dedup import dedup_lines as spark_dedup
from casetrends.llm.packing import OpenBins, pieces_of
from casetrends.llm.quality import Measures, quality_filter, quality_report
from casetrends.llm.queries import packed
from casetrends.llm.secret_scan import scan_secrets, written
from casetrends.llm.sharding import assign_shards

ODD = [
    None, "", "\n", " \t\r\n", "a", "ÀÉ ß 漢字 \U0001F600 x", "x" * 50_000, "wort " * 20_000,
    "one two three four five", "ONE two\nthree, four five",
    "a line that stands in two texts\nand one that does not",
    "  A line that STANDS in two texts\t\nmore\n\nend",
]


def same_rows(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


def frames(spark):
    """Odd rows, one of them repeated, one without id; the same with clashing names."""
    rows = list(enumerate(ODD)) + [(3, ODD[3]), (10, ODD[10]), (None, ODD[10]), (None, None)]
    return rows, documents(spark, rows), documents(spark, rows, clash=True)


def test_line_dedup(spark):
    rows, df, clash = frames(spark)
    want = [(i, *x) for (i, _), x in zip(rows, dedup_lines(rows))]
    got = spark_dedup(df).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert same_rows(map(tuple, got), want)
    other = spark_dedup(clash, counts=None)
    assert other.columns == clash.columns
    assert same_rows([r["text"] for r in other.collect()], [w[3] for w in want])
    assert spark_dedup(df.limit(0)).count() == 0


def test_line_dedup_threshold(spark):
    rows = [(i, f"shared by all of them\nonly {i % 2} have this one") for i in range(4)]
    got = {r["doc_id"]: r["text"] for r in spark_dedup(documents(spark, rows), min_docs=3).collect()}
    assert got[0] == rows[0][1] and got[3] == "only 1 have this one"


def test_secrets(spark):
    access, key = "AKIA" + "Q7" * 8, "aB3/" * 10
    texts = [
        None, "", f"id {access} key {key} at https://a.example:8443/x", f"key {key} alone",
        f"{access}" + " far" * 200 + f" {key}", "password: abc, token='abcdef' apikey = zzzzzzz",
        "ü" + "a1" * 12, "secret=token:abcdef", f"https://a.example {access} password=hunter22",
    ]
    got = {r["id"]: r["s"] for r in _written(scan_secrets(documents(spark, texts))).collect()}
    assert got[0] == got[1] == ""
    assert got[2] == "access:3:23,key_part:28:68,endpoint:72:94"
    assert got[3] == "" and got[4] == "access:0:20"
    assert got[5] == "assign:15:28,assign:30:46"
    assert got[6] == "hex:1:25" and got[7] == ""
    assert got[8] == "endpoint:0:17,access:18:38,assign:39:56"
    rows, df, clash = frames(spark)
    assert scan_secrets(clash).count() == len(rows)
    assert scan_secrets(df.limit(0)).count() == 0


def _written(found):
    return found.select("id", written(found["spans"]).alias("s"))


def test_decontamination(spark):
    item = "the quick brown fox jumps over the lazy dog and then it sleeps again until noon"
    items = [(1, item), (2, "short one"), (3, None), (None, "zz yy"), (2, "short one"), (4, "")]
    texts = [
        *ODD, f"Before. {item.upper()}!", item + " " + item, "a short one, and a SHORT, one",
        " ".join(item.split()[:12]), "pre " * 300 + item, "zz yy",
    ]
    rows = list(enumerate(texts)) + [(12, texts[12]), (None, texts[13])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, rows)
    got = []
    for r in find_contamination(df, bench).select(
        "id", "n_rows", "n_words", covered_of("spans"), "items"
    ).collect():
        got += [(r[0], r[2], r[3], tuple(sorted(r[4])))] * r[1]
    want = [(i, *contamination(t, items)[:2], tuple(sorted(contamination(t, items)[2])))
            for i, t in rows]
    assert same_rows(got, want)
    clash = documents(spark, rows, clash=True)
    kept = remove_documents(clash, bench)
    assert kept.columns == clash.columns
    bad = [w[2] > 0 and 20 * w[2] >= w[1] for w in want]
    assert kept.count() == len(rows) - sum(bad)
    cut = {r["doc_id"]: r["text"] for r in remove_spans(clash, bench).collect()}
    assert cut[12] == "Before. " and cut[14] == "a and a " and cut[0] is None
    assert cut[16] == "pre " * 300 and cut[7] == ODD[7]
    assert find_contamination(df.limit(0), bench).count() == 0
    empty = find_contamination(df, bench.limit(0))
    assert empty.where("size(spans) > 0").count() == 0 and empty.count() > 0


def covered_of(name):
    from pyspark.sql import functions as F

    return covered(F.col(name))


def jump(key, shards):
    """The published loop."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(spark):
    ids = [*range(500), -5, 2**62 + 12345, -(2**63), None, None, 7, 7]
    rows = [(i, "x" * ((i or 0) % 7)) for i in ids]
    got = assign_shards(documents(spark, rows, clash=True), shards=16).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["shard"] == jump((r["id"] or 0) % 2**64, 16)
        assert r["grown_shard"] == jump((r["id"] or 0) % 2**64, 17)
        assert r["grown_shard"] in (r["shard"], 16)
    for shard in range(16):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in got))
        )
    assert assign_shards(documents(spark, rows).limit(0)).count() == 0
    named = documents(spark, rows).selectExpr("concat('n', doc_id) AS doc_id", "text")
    assert assign_shards(named, shards=3).where("shard BETWEEN 0 AND 2").count() == len(rows)


def test_quality(spark):
    texts = [*ODD, "a b c d e f a b c d e f g", "x y\nx y\nx y\n\n\n", "w " * 9 + "w", "#a $b"]
    for t in texts:
        m = Measures(t)
        assert (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words) == measures(t)
    rows, df, clash = frames(spark)
    kept = quality_filter(clash)
    assert kept.columns == clash.columns and kept.where("text IS NULL").count() == 0
    assert quality_report(df).count() == len(rows)
    assert quality_filter(df.limit(0)).count() == 0


def test_language(spark):
    rows = [(i, "the cat and the other thing of that") for i in range(20)]
    train = documents(spark, rows).unionAll(
        documents(spark, [(i, "ñandú que el niño español") for i in range(20)]).replace(
            "en", "es", "lang"
        )
    )
    models = fit_models(train)
    known = "The cat and the other thing of that."
    texts = [None, "", "123 !?", known, "el niño", "漢字", "ab" * 30_000]
    got = {r["doc_id"]: r["language"] for r in predict(documents(spark, texts, True), models, "text").collect()}
    assert [got[i]["lang"] for i in range(3)] == ["und"] * 3
    assert got[3]["lang"] == "en" and got[4]["lang"] == "es"
    assert got[3]["accepted"] and not got[5]["accepted"]
    assert all(0 <= g["score"] <= 1 for g in got.values())
    nothing = fit_models(train.limit(0))
    assert {r["language"]["lang"] for r in predict(train, nothing, "text").collect()} == {"und"}
    assert predict(train.limit(0), models, "text").count() == 0


def test_grams_of_models_are_exact(spark):
    """Many different grams: each keeps its own probability, sent to tasks or joined in Spark."""
    from casetrends.llm import langid

    rng = random.Random(5)
    letters = {"zh": range(0x4E00, 0x7E00), "ja": range(0x6E00, 0x9E00)}
    texts = [
        (lang, "".join(chr(rng.choice(x)) for _ in range(3000)))
        for lang, x in letters.items() for _ in range(20)
    ]
    rows = [(i, text) for i, (_, text) in enumerate(texts)]
    train = documents(spark, rows[:20]).unionAll(documents(spark, rows[20:]).replace("en", "ja", "lang"))
    sent, stored = fit_models(train), fit_models(train, max_mb=1)
    assert isinstance(sent, langid.Models) and isinstance(stored, langid.StoredModels)
    distinct = {text[i : i + 4] for _, text in texts for i in range(len(text) - 3)}
    # All of them; as hashes of 19 bits some of them were one.
    assert len(sent.keys[4]) >= len(distinct) > 100_000
    docs = documents(spark, [*[t[:400] for _, t in texts], None, "", "12", "xyz"], clash=True)
    got, other = (
        {r["doc_id"]: r["language"] for r in predict(docs, m, "text").collect()}
        for m in (sent, stored)
    )
    assert len(got) == len(other) == docs.count()
    for i, g in got.items():
        assert g["lang"] == other[i]["lang"] and g["accepted"] == other[i]["accepted"]
        assert g["score"] == pytest.approx(other[i]["score"], abs=1e-5)
    assert list(sent.limits) == pytest.approx(list(stored.limits), rel=1e-5)
    # A gram no text has backs off: its score is that of the shorter one and of what is left.
    unseen = next(x for x in ("\u4e00" * 4, "\u4e01" * 4) if x not in distinct)
    packed = langid.grams([unseen])[0][3:4]
    assert not langid.Models._find(sent.keys[4], packed)[1].any()


def test_grams_of_a_whole_batch_equal_those_of_each_text():
    import numpy as np

    from casetrends.llm import langid

    rng = random.Random(3)
    pool = "aZñİΣςß²½Ⅷ٣_-\n\t 9𝐀😀𐐀漢字̇ǅ "
    texts = [None, "", "12", "²½", "\n", "😀", "𝐀 b", "ΑΣ.Σ", "½𝟙", "ab" * langid.CHUNK]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(30))) for _ in range(3000)]
    want = []
    for text in map(langid.normalised, texts):
        codes = (langid.PAD + text + " ").encode("utf-16-le") if text else b""
        chars = [int.from_bytes(codes[i : i + 2], "little") for i in range(0, len(codes), 2)]
        want.append([sum(c << (48 - 16 * k) for k, c in enumerate(chars[i : i + 4])) for i in range(len(chars) - 3)])
    packed, sizes = langid.grams(texts)
    assert sizes.tolist() == [len(w) for w in want]
    assert packed.tolist() == [g for w in want for g in w]
    parts = [langid.grams(texts[low:high])[0] for low, high in langid.chunks(texts)]
    assert len(parts) > 2 and np.array_equal(np.concatenate(parts), packed)
    keys = np.unique(packed)[::3]
    at, known = langid.Places(keys).find(packed)
    assert np.array_equal(known, np.isin(packed, keys)) and np.array_equal(keys[at[known]], packed[known])


def test_limits_of_rejection_take_all_texts(spark):
    """A language whose texts come after thousands of another one's has a limit, too."""
    rows = [(i, "the cat and the other thing of that") for i in range(2500)]
    last = [(i, "ñandú que el niño español") for i in range(20)]
    train = documents(spark, rows).unionAll(documents(spark, last).replace("en", "es", "lang"))
    models = fit_models(train.coalesce(1))
    assert models.langs == ["en", "es"] and all(x < 100 for x in models.limits)


def test_models_sum_to_one(spark):
    from casetrends.llm import langid

    train = documents(spark, ["abab abba baab", "aabb"])
    p = langid.kneser_ney(langid.count_grams(train, "text", "lang"))
    for size in (1, 2, 3):
        rest = p.where(f"size = {-size - 1}").collect()
        known = {}
        for r in p.where(f"size = {size + 1}").collect():
            context = (r["gram"] % 2**64) >> 16
            known.setdefault(context, {})[r["gram"] % 65536] = r["p"]
        lower = {r["gram"] % 2**64: r["p"] for r in p.where(f"size = {size}").collect()}
        for r in rest:
            context = r["gram"] % 2**64
            seen = known[context]
            suffix = context % (1 << (16 * (size - 1))) << 16
            backed = sum(lower.get(suffix + c, 0.0) for c in seen)
            whole = sum(x for g, x in lower.items() if g >> 16 == suffix >> 16)
            assert sum(seen.values()) + r["p"] * (1 - backed) == pytest.approx(1, abs=1e-9) or whole < 1


def test_similar_texts(spark):
    base = [f"w{i}" for i in range(120)]
    near = [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(0, 120, 3)]
    texts = [*ODD, " ".join(base), *near, " ".join(base[60:] + base[:60]), " ".join(base).upper()]
    rows = list(enumerate(texts)) + [(12, texts[12]), (None, texts[12]), (None, "only here")]
    got = similar_texts(documents(spark, rows, clash=True)).collect()
    want = [(i, *x) for (i, _), x in zip(rows, classes(rows))]
    assert same_rows([(r["id"], r["class_id"], r["n_links"], r["n_copies"]) for r in got], want)
    clash = documents(spark, rows, clash=True)
    kept = one_of_each_class(clash)
    assert kept.columns == clash.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        {w[1] for w in want if w[1] is not None}
    )
    assert similar_texts(documents(spark, rows).limit(0)).count() == 0


def test_large_groups(spark, monkeypatch):
    """Groups beyond every bound are split, and still compared whole."""
    from casetrends.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "SMALL", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "DEPTH", 3)
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base[:k] + ["x", str(k)] + base[k:]) for k in range(60)]
    passage = " ".join(f"p{i}" for i in range(50))
    texts += [passage + " " + " ".join(f"{k}q{i}" for i in range(40)) for k in range(60)]
    rows = list(enumerate(texts))
    got = similar_texts(documents(spark, rows)).collect()
    want = [(i, *x) for (i, _), x in zip(rows, classes(rows))]
    assert same_rows([(r["id"], r["class_id"], r["n_links"], r["n_copies"]) for r in got], want)


@pytest.mark.parametrize("text", [
    "</s>[INST] ok [/INST]", "<\\s> [\\\\INST] <<SYS>> <</SYS>> <<s>", "[", "a\\", "<", "</s", "",
])
def test_escape(text):
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>"))


def test_chat(spark):
    turns = [(1, 0, "system", "be kind")]
    turns += [(1, k, "user" if k % 2 else "assistant", f"turn {k} " * (k % 40)) for k in range(1, 400)]
    turns += [(2, 0, None, None), (2, 0, "assistant", "tie"), (2, None, "assistant", "first")]
    turns += [(None, 1, "user", "<s>"), (3, 1, "tool\n[/INST]", "x" * 9000), (3, 1, "tool\n[/INST]", "x" * 9000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "turn AS segment", "'a' AS window", "'b' AS rows", "1 AS tokens")
    windows = format_windows(df, budget=200, history=50, segment=1000)
    said = {}
    for r in read_back(windows).orderBy("conv", "segment", "window").collect():
        said.setdefault(r["conv"], []).append(r)
    def text(conv):
        return "".join(r["turns"] for r in said[conv])
    assert text(1) == "".join(f"{r}\n{t}\n" for _, _, r, t in turns[:400])
    assert "".join(r["loss_text"] for r in said[1]) == "".join(
        t for c, _, r, t in turns if c == 1 and r == "assistant"
    )
    assert text(2) == "assistant\nfirst\n\n\n" + "\n" * 0 + "assistant\ntie\n"
    assert text(None) == "user\n<s>\n"
    assert text(3) == ("tool\n[/INST]\n" + "x" * 9000 + "\n") * 2
    assert windows.where("conv = 1").select("segment").distinct().count() > 1
    assert windows.where("conv = 1 AND NOT startswith(text, '<s>[INST] system')").count() == 0
    assert format_windows(df.limit(0)).count() == 0


def test_bins():
    bins = OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 3, 4, 10, 5, 1)] == [
        (0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0), (3, 5)
    ]
    bins = OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 7, 8, 4)] == [(0, 0), (1, 0), (2, 0), (0, 6)]
    assert pieces_of(1, 4) == [(0, 1)] and pieces_of(4, 4) == [(0, 4)]
    assert pieces_of(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_packing(spark):
    import public_tokenizers
    from plain import crc, token_ids
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*ODD, "a<|endoftext|>b", "\u0085x y​  z\x1c\n\n end", "'S it's 1² ½"]
    rows = list(enumerate(texts)) + [(2**60 + 1, "big"), (None, "none")]
    got = {}
    for r in packed(documents(spark, rows, clash=True)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in rows:
        ids = token_ids(text, tokenizer)
        for r in got[i]:
            assert crc(ids[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"]
        assert sum(r["length"] for r in got[i]) == len(ids)
    assert packed(documents(spark, rows).limit(0)).count() == 0


def test_licenses(spark):
    texts = [
        *ODD, "x y\n  Released under the MIT license\nz", "Licensed under CC BY-NC 4.0.",
        "intro\n\nPermission to use, copy, modify, and/or distribute this software for any purpose\n"
        "with or without fee is hereby granted, provided that the above copyright notice and this\n"
        "permission notice appear in all copies.\n\nrest",
        "the the the the the the",
    ]
    rows = list(enumerate(texts)) + [(13, texts[13]), (None, texts[13])]
    got = {}
    for r in scan_licenses(documents(spark, rows, clash=True)).collect():
        got.setdefault(r["id"], []).append([(m["license"], round(m["dice"], 2)) for m in r["matches"]])
    assert got[12] == [[("MIT", 1.0)]]
    assert got[13] == [[("CC-BY-NC-4.0", 1.0)]] * 2 and got[None] == [[("CC-BY-NC-4.0", 1.0)]]
    assert ("ISC", 1.0) in got[14][0] and got[15] == [[]] and got[0] == [[]]
    assert scan_licenses(documents(spark, rows).limit(0)).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    rows, _, clash = frames(spark)
    assert set(CLASHES) <= set(clash.columns)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash, "/root/testdata/sf0.001")
        assert out.columns == clash.columns, name
        assert out.dtypes == clash.dtypes, name
    assert words("A b") == ["a", "b"]


def test_strays_of_a_large_connected_node(spark):
    from itertools import combinations

    from casetrends.llm.jaccard_join import similar_texts

    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base[:-1], f"end{i}"]) for i in range(300)]
    texts += [" ".join([*base[:20], *(f"s{i}x{k}" for k in range(40))]) for i in range(8)]
    texts += [texts[-1] + " more", " ".join(base[:50])]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    links = [0] * len(texts)
    for i, j in combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
    found = similar_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.id: (r.class_id, r.n_links) for r in found.collect()}
    assert [got[i][1] for i in range(len(texts))] == links
    assert got[309][0] == 0 and got[308][0] == 307 and got[300][0] == 300


def test_near_copies_around_the_threshold(spark, monkeypatch):
    """Nodes that stay large after a split are compared through each text's largest node."""
    from random import Random

    from casetrends.llm import jaccard_join

    for name, value in (("SMALL", 4), ("BLOCK", 8), ("DEPTH", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    draw = Random(1)
    texts = []
    for k in range(110):
        words = [f"w{i}" for i in range(150)]
        for i in draw.sample(range(150), 3):
            words[i] = f"z{k}_{i}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts))
    got = similar_texts(documents(spark, rows)).collect()
    want = [(i, *x) for (i, _), x in zip(rows, classes(rows))]
    assert same_rows([(r["id"], r["class_id"], r["n_links"], r["n_copies"]) for r in got], want)

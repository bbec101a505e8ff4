"""Balanced packing, structure repair and phrase mining against plain Python."""

import itertools
import os
import random
from collections import Counter, defaultdict

import pytest
from plain import ASCII, crc, documents, sha
from pyspark.sql import functions as F

from casetrends.llm import balanced_packing, phrases, structure_repair
from casetrends.llm.structure_queries import damaged, repair_report

SF = "/root/testdata/sf0.001"
here = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# --- balanced packing -----------------------------------------------------------------------------


def check_pieces(rows, texts, tokenizer, capacity=2048):
    """Pieces hold each document's ids once, sequences are full or a power of two long."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == texts.keys()
    for name, text in texts.items():
        ids, at = tokenizer.encode(text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[name], key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in part)
            at += r["length"]
        assert at == len(ids)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == capacity or at < capacity and at & (at - 1) == 0
    return places


def test_pieces_of_odd_texts(spark, path, tokenizer):
    texts = [
        None, "", " \n\t", "Hello, World!!", "don't 'TIS İstanbul Éaile ΣΑΣ ß 中文。", "a" * 200_001,
        "<|endoftext|> <|ENDOFTEXT|>x", "x " * 5000, "H̱á \x1c\x85 \x0b\x0c 1½٣", "Hello, World!!",
    ]
    docs = documents(spark, texts, clash=True).repartition(3)
    got = balanced_packing.pack_balanced(docs, path, group_sequences=4).collect()
    check_pieces(got, dict(enumerate(texts)), tokenizer)
    assert balanced_packing.pack_balanced(documents(spark, []), path).count() == 0
    same = documents(spark, [(7, "one two"), (7, "one two"), (None, "three")])
    rows = balanced_packing.pack_balanced(same, path).collect()
    assert Counter(r["id"] for r in rows)[7] >= 2 and any(r["id"] is None for r in rows)


def test_coder_equals_the_tokenizer(path, tokenizer):
    import pyarrow as pa

    random.seed(5)
    letters = [chr(c) for c in range(0x20, 0x250)] + [
        "<|startoftext|>", "́", "̱", "'s", "'LL", "\n", "中", "\U0001f600", "‍", "ﬁ"
    ] + list(" .,'") * 60
    texts = ["".join(random.choices(letters, k=random.randint(0, 14))) for _ in range(5000)]
    coder = balanced_packing.WordCoder(path)
    for text, ids in zip(texts, coder.encode(pa.array(texts))):
        assert tokenizer.encode(text, add_special_tokens=False).ids == ids.tolist(), text


def test_sequences_are_full_and_balanced():
    random.seed(3)
    for _ in range(200):
        capacity = random.choice((8, 64))
        lengths = [random.randint(1, capacity - 1) for _ in range(random.randint(1, 60))]
        sizes = balanced_packing.room_for(sum(lengths), capacity)
        assert sum(sizes) == sum(lengths) and len(sizes) <= sum(lengths) // capacity + 6
        placed = balanced_packing.balance(lengths, sizes, 1.0, 0.1)
        fill, parts = Counter(), defaultdict(list)
        for doc, start, n, sequence, offset in placed:
            assert offset == fill[sequence]
            fill[sequence] += n
            parts[doc].append((start, n))
        assert [fill[k] for k in range(len(sizes))] == sizes
        for doc, own in parts.items():
            at = 0
            for start, n in sorted(own):
                assert start == at
                at += n
            assert at == lengths[doc]
    # The longest go apart, the short ones to the cheaper sequences.
    placed = balanced_packing.balance([6, 6, 2, 2], [8, 8], 1.0, 1.0)
    assert sorted((d, s) for d, _, _, s, _ in placed) == [(0, 0), (1, 1), (2, 0), (3, 1)]


@here
def test_query_of_whole_documents(spark, tokenizer):
    from casetrends.llm import QUERIES

    rows = QUERIES["op11_packing"](spark, SF).collect()
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for d, t in texts.items()}
    places = defaultdict(int)
    assert {r["doc_id"] for r in rows} == texts.keys()
    for r in rows:
        assert r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]])
        places[r["sequence_id"]] += r["length"]
    assert sum(places.values()) == sum(map(len, ids.values()))
    assert all(n & (n - 1) == 0 for n in places.values())


# --- structure repair -----------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string"


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying, row by row, the least way into each state."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def put_in(ways):
        for _ in range(3):
            for state, (c, a, t) in list(ways.items()):
                for x in "ua":
                    if (state, x) in step:
                        new = (c + 5, a + "I", [*t, f"{name[x]}:"])
                        ways[x] = min(ways.get(x, new), new)
        return ways

    ways = {"": (0, "", [])}
    for (_, role, text), fault in zip(rows, faults(rows)):
        new, more = {}, 5 if fault == "truncated" else 0
        for state, (c, a, t) in put_in(ways).items():
            tries = [(state, (c + 2, a + "D", t))]
            if fault not in ("blank", "duplicate"):
                if (state, role[:1]) in step:
                    tries.append((step[state, role[:1]], (c + more, a + "K", [*t, f"{role}:{text}"])))
                for x in "ua":
                    if (state, x) in step:
                        tries.append((x, (c + 1 + more, a + "R", [*t, f"{name[x]}:{text}"])))
            for to, way in tries:
                new[to] = min(new.get(to, way), way)
        ways = new
    return min(w for s, w in put_in(ways).items() if s in ("", "a"))


def expected(rows):
    """Counts, audit and digest of the rows of one conversation, in any order."""
    rows = sorted(
        ((t, r or " " if r is not None else " ", " " if x is None else x) for t, r, x in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()),
    )
    turns = [t for t, _, _ in rows if t is not None]
    found = faults(rows)
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, said = cheapest(rows)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(found.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, sha("\n".join(said)),
    )


def conversations(seed, n, longest=12):
    random.seed(seed)
    out = []
    for conv in range(n):
        for turn in range(random.randint(1, longest)):
            out.append((
                conv if conv else None,
                random.choice((turn, turn, turn, None, 3)),
                random.choice(("user", "assistant", "user", "assistant", "system", "tool", None, "")),
                random.choice(("Yes.", "No!", "cut", "", " \t", "Why?  ", None, f"T{turn}.", f"t{turn}")),
            ))
    return out


@pytest.mark.parametrize("slice_rows", [4096, 4, 1])
def test_repair_is_the_cheapest(spark, slice_rows):
    rows = [r for r in conversations(slice_rows, 120) if r[2] != ""]
    df = spark.createDataFrame(rows, TURNS).withColumn("pos", F.lit("x")).withColumn("at", F.lit(1))
    found = structure_repair.repair_conversations(df, slice_rows=slice_rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(df, found).collect()}
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn, role, text))
    assert got == {conv: expected(own) for conv, own in by_conv.items()}
    assert {x for v in got.values() for x in v[6]} == set("DKR")


def test_a_long_conversation_in_slices(spark):
    random.seed(8)
    rows = [(1, k, random.choice(("user", "assistant")), random.choice((f"T{k}.", f"t{k}", "Same.")))
            for k in range(1500)] + [(2, 0, "user", "Hi.")]
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    found = structure_repair.repair_conversations(df, slice_rows=64)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(df, found).collect()}
    assert got[1] == expected([r[1:] for r in rows if r[0] == 1])
    assert got[2][6] == "D"
    assert found.audits.where("conv = 1").count() > 20


def test_empty_roles_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "", "Hello."), (1, 1, "assistant", "Yes.")], TURNS)
    found = structure_repair.repair_conversations(df)
    assert [r["edit"] for r in found.edits.orderBy("at", "step").collect()] == ["R", "K"]
    nothing = spark.createDataFrame([], TURNS)
    found = structure_repair.repair_conversations(nothing)
    assert found.edits.count() == found.summary.count() == 0
    assert repair_report(nothing, found).count() == 0
    # A conversation whose rows are all gone has zeros.
    report = repair_report(df, found).collect()
    assert [tuple(r) for r in report] == [(1, 0, 0, 0, 0, 0, 0, "", sha(""))]


def test_damage_is_dealt_by_hash(spark):
    import zlib

    df = spark.createDataFrame([(k, t, "user", "A. B!") for k in range(60) for t in (0, None)], TURNS)
    got = Counter((r["conv_id"], r["turn"], r["text"]) for r in damaged(df).collect())
    want = Counter()
    for k, t in itertools.product(range(60), (0, None)):
        fate = zlib.crc32(f"{k}:{' ' if t is None else t}".encode()) % 20
        if fate:
            want[(k, t, {1: "", 2: "A B"}.get(fate, "A. B!"))] += 2 if fate == 3 else 1
    assert got == want


# --- phrases ----------------------------------------------------------------------------------------


def phrase_rows(rows, least, top=2000):
    import re

    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(ASCII)):
            own = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(own)
            for n in (1, 2, 3, 4):
                for i in range(len(own) - n + 1):
                    counts[lang][tuple(own[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        listed = []
        for p, a in f.items():
            if len(p) > 1 and a >= least:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                inside = any(
                    100 * b >= 80 * a and len(q) > len(p) and b >= least
                    and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                    for q, b in f.items()
                )
                if not inside:
                    listed.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(listed)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


def mined(spark, rows, least, shard_words):
    from pyspark.sql import Window

    docs = spark.createDataFrame(
        [(k, t, lang, "x") for k, (lang, t) in enumerate(rows)],
        "doc_id long, text string, lang string, phrase string",
    ).repartition(4)
    found, n = phrases.mine_phrases(docs, least=least, shard_words=shard_words)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.where("NOT covered").withColumn("rank", F.row_number().over(best))
    return sorted(
        tuple(r) for r in ranked.join(n, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()
    )


@pytest.mark.parametrize("shard_words", [1 << 21, 40])
def test_phrases_equal_plain_counts(spark, shard_words):
    random.seed(shard_words)
    pool = ["a", "B", "b", "c", "é", "É", "\x00", "中"]
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", "-", ":"]
    rows = [
        (random.choice(("en", "de", None)), "".join(
            random.choice(pool) + random.choice(marks) for _ in range(random.randint(0, 40))
        ))
        for _ in range(150)
    ] + [("en", None), ("en", ""), (None, "..."), ("xx", "alone"), ("en", "a b " * 400)]
    got = mined(spark, rows, 4, shard_words)
    assert got == phrase_rows(rows, 4)
    assert len(got) > 50


def test_no_phrases(spark):
    assert mined(spark, [], 2, 100) == []
    assert mined(spark, [(None, None), ("en", "a. b. c")], 1, 100) == []


def test_pairs_are_counted_in_one_round(spark, monkeypatch):
    made, rounds = [], phrases.phrases_of_shards

    def kept(*args):
        made.append(rounds(*args))
        return made[-1]

    monkeypatch.setattr(phrases, "phrases_of_shards", kept)
    rows = [(lang, "a b. b c, a c; " * 5) for lang in ("en", "de", None)]
    got = mined(spark, rows, 5, 10)
    assert got == phrase_rows(rows, 5) and len(got) == 9
    # No phrase is longer than a pair, so the round after the pairs' has nothing to count.
    assert [m.count() for m in made] == [0]


def test_small_shards_are_merged_and_cut():
    import numpy as np

    a, b = (np.array([1, 2, 0]), np.array([0, 7, 5])), (np.array([2, 1, 3, 0]), np.array([0, 9, 7, 0]))
    (text, words), = phrases.gathered(iter([a, b]), 7)
    assert words[text].tolist() == [7, 5, 0, 0, 7, 9, 0, 0, 0]
    assert len(list(phrases.gathered(iter([a, b]), 6))) == 2
    assert phrases.long_runs(np.array([1, 0, 2, 3, 0, 0, 4, 5, 6]), 2).tolist() == [0, 2, 3, 0, 4, 5, 6]
    assert phrases.long_runs(np.array([1, 0, 2, 3, 0, 0, 4, 5, 6]), 3).tolist() == [0, 4, 5, 6]
    assert not phrases.long_runs(np.array([], int), 2).any()
    cut = phrases.kept_pairs(np.array([1, 2, 1, 0]), np.array([0, 7, 5]), np.array([7 << 32 | 5]))
    assert cut.tolist() == [1, 2, 0, 1, 0]


def test_index_extends_both_ways():
    import numpy as np

    random.seed(2)
    text = np.array([random.choice((0, 1, 2, 3, 3)) for _ in range(300)])
    index = phrases.PhraseIndex(text, 4)
    whole = [0, *text.tolist(), 0]

    def plain(n):
        grams = Counter(tuple(whole[i : i + n]) for i in range(len(whole) - n + 1))
        return {g: c for g, c in grams.items() if 0 not in g}

    for ways in itertools.product((True, False), repeat=3):
        found = index.words()
        for n, to_left in enumerate(ways, 2):
            found = index.extend(found, to_left)
            got = dict(zip(map(tuple, found["words"].tolist()), (found["high"] - found["low"]).tolist()))
            assert got == plain(n)
            assert ((found["high"] - found["low"]) == (found["high2"] - found["low2"])).all()


# --- earlier operators on long texts --------------------------------------------------------------


def test_many_secrets_in_one_text(spark):
    import time

    from casetrends.llm import secret_scan

    n = 64_000
    docs = documents(spark, ["token=abcdefg1 é " * n, None])
    began = time.time()
    found = {r["id"]: r["base"] for r in secret_scan.scan_secrets(docs).collect()}
    assert found[1] == [] and time.time() - began < 30
    assert [(s["start"], s["end"]) for s in found[0]] == [(17 * k, 17 * k + 14) for k in range(n)]


def test_long_runs_of_white_space(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = " ".join(f"word{k}" for k in range(40))
    texts = [f"{words}{' ' * 2_000_000}end.", f"{words}{chr(10) * 2_000_000}end."]
    rows = corpus_pipeline.packing_stage(spark, documents(spark, texts), SF).collect()
    for k, text in enumerate(texts):
        ids = coder.encode(text, add_special_tokens=False).ids + [2]
        own = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == len(ids)
        assert own[0]["ids_crc32"] == crc(ids[: own[0]["length"]])
    kept = corpus_pipeline.quality_stage(spark, documents(spark, texts), SF)
    assert kept.count() == 2


def test_cascade_judges_as_all_rules_do(spark):
    from casetrends.llm import quality

    random.seed(4)
    texts = [None, "", "a", "- x\n- y\n- z\n- one two three four five six seven eight", "wait...\nno...\nyes it is so and so on and on and on"]
    texts += [" ".join(random.choices(["a", "bb", "$", "x" * 30, "w.", "\n", "the", "-"], k=random.randint(0, 60))) for _ in range(200)]
    docs = documents(spark, texts, clash=True)
    rules = quality.production_rules()
    want = {k: any(r.fails(quality.Measures(t)) for r in rules) for k, t in enumerate(texts)}
    report = {r["doc_id"]: r["quality"] for r in quality.quality_report(docs).collect()}
    assert {k: r["rejected_by"] is not None for k, r in report.items()} == want
    assert 20 < sum(want.values()) < len(texts)
    kept = {r["doc_id"] for r in quality.quality_filter(docs).collect()}
    assert kept == {k for k, bad in want.items() if not bad}
    nothing = documents(spark, [])
    assert quality.quality_report(nothing).count() == quality.quality_filter(nothing).count() == 0


def test_cascade_counts_what_earlier_rules_leave():
    from casetrends.llm.quality import Rule, Sample, cascade_order

    rules = (Rule("a", None, ("m",)), Rule("b", None, ("m", "n")), Rule("c", None, ("k",)))
    # a rejects most; what b rejects beyond a is little, c catches others.
    found = Sample({0: 50, 0b011: 30, 0b001: 10, 0b100: 10}, {"m": 1.0, "n": 1.0, "k": 1.0}, {})
    assert [r.name for r in cascade_order(rules, found)] == ["a", "c", "b"]
    # A measure that is there already costs nothing.
    found = Sample({0b001: 10, 0b010: 10, 0b100: 11}, {"m": 1.0, "n": 0.0, "k": 1.05}, {})
    assert [r.name for r in cascade_order(rules, found)] == ["c", "a", "b"]

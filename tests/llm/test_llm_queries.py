"""Registered corpus queries against their SQL, or against the rules in plain Python."""

import hashlib
import os
import zlib
from collections import defaultdict

import pytest
from oracle import compare, connect
from plain import classes, crc, measures, sha, token_ids

from casetrends.llm import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF) == []


@pytest.fixture(scope="module")
def docs(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


def test_quality(spark, docs):
    got = {r["doc_id"]: r for r in QUERIES["op5_quality_rules"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        m = measures(text)
        r = got[i]
        assert tuple(r)[1:6] == m
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert sum(r["kept"] for r in got.values()) > len(docs) * 0.7


def test_language(spark, con):
    truth = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    got = QUERIES["op6_language_id"](spark, SF).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held)
    assert len(held) > 20 and right >= 0.98 * len(held)


def test_similar_texts(spark, docs):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op7_ngram_jaccard_join"](spark, SF).collect()}
    assert got == dict(zip(docs, classes(list(docs.items()))))


def test_chat(spark, con):
    turns = defaultdict(list)
    for conv, role, text in con.sql(
        "SELECT conv_id, role, text FROM conversations ORDER BY conv_id, turn"
    ).fetchall():
        turns[conv].append((role, text or ""))
    control = "</s>[INST] ok [/INST]"
    turns[-1] = [("user", control), ("assistant", control)]
    got = {r["conv_id"]: r for r in QUERIES["op8_chat_formatting"](spark, SF).collect()}
    assert got.keys() == turns.keys()
    for conv, said in turns.items():
        r = got[conv]
        assert r["n_turns"] == len(said)
        assert r["turns_sha256"] == sha("".join(f"{a}\n{b}\n" for a, b in said))
        loss = "".join(b for a, b in said if a == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
    assert any(r["n_windows"] > 1 for r in got.values())


def test_packing(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, places, total = defaultdict(list), defaultdict(list), 0
    for r in QUERIES["op9_best_fit_packing"](spark, SF).collect():
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == docs.keys()
    for i, text in docs.items():
        ids, at = token_ids(text, tokenizer), 0
        total += len(ids)
        rows = sorted(pieces[i], key=lambda r: r["piece"])
        for k, r in enumerate(rows):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == crc(ids[at : at + r["length"]])
            assert k == 0 or r["length"] == 1024
            at += r["length"]
        assert at == len(ids) and (len(rows) == 1 or len(ids) > 1024)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= 1.1 * total / 1024 + 2


def test_pipeline(spark, docs, con):
    import corpus_pipeline
    import public_tokenizers
    from plain import contamination, dedup_lines
    from tokenizers import Tokenizer

    from casetrends.llm.quality import Measures, production_rules

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, t) for i, t in docs.items()
            if not any(rule.fails(Measures(t)) for rule in production_rules())]
    rows = [(i, kept) for (i, _), (_, _, kept) in zip(rows, dedup_lines(rows))]
    rows = [(i, t) for (i, t), (least, _, _) in zip(rows, classes(rows)) if i == least]
    items = con.sql("SELECT item_id, text FROM benchmark").fetchall()
    want = {}
    for i, t in rows:
        n, hit, _ = contamination(t, items)
        if not (hit and 20 * hit >= n):
            want[i] = crc(token_ids(t, tokenizer)[:1]), len(token_ids(t, tokenizer))
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r["doc_id"]] += r["length"]
    assert got == {i: n for i, (_, n) in want.items()}
    assert len(got) < len(docs)


def test_digest_helpers():
    assert sha("") == hashlib.sha256(b"").hexdigest()

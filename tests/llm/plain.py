"""The operators' rules in plain Python, and small tables to hold against them."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that operators use inside, on top of those of documents.
CLASHES = ["k1", "k2", "rec", "lines", "drops", "shard", "id", "q", "n_words", "rejected_by", "spans"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, texts, clash=False):
    """Rows of documents; items are a text or an (id, text) pair."""
    pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in pairs], DOCS
    )
    if clash:
        df = df.selectExpr("*", *[f"concat('x', doc_id) AS `{c}`" for c in CLASHES])
    return df


def words(text):
    return WORD.findall((text or "").translate(ASCII))


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def dedup_lines(rows):
    """``[(id, text)]`` -> by row (n_lines, n_dropped, text)."""
    white = " \t\n\x0b\x0c\r"
    holders = {}
    key = lambda line: line.strip(white).translate(ASCII)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if i is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i
        ]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def contamination(text, items, window=13):
    """(n_words, n_hit, ids)"""
    w = words(text)
    hit, ids = set(), set()
    for item, item_text in items:
        x = words(item_text)
        n = min(len(x), window)
        grams = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in grams:
                hit.update(range(i, i + n))
                if item is not None:
                    ids.add(item)
    return len(w), len(hit), ids


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = {}
    for i in range(len(w) - 4):
        grams.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)
    )


def classes(rows, threshold=0.8):
    """``[(id, text)]`` -> by row (class id, links, copies), all pairs compared."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    sets = [shingles(t) for t in texts]
    links = {
        i: {j for j in range(len(texts)) if j != i and jaccard(sets[i], sets[j]) >= threshold}
        for i in range(len(texts))
    }
    root = {}
    for i in range(len(texts)):
        todo = [i] if i not in root else []
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = i
                todo += links[x]
    number = {t: i for i, t in enumerate(texts)}
    ids = {}
    for i, t in rows:
        ids.setdefault(root[number[t or ""]], []).append(i)
    out = []
    for _, t in rows:
        n = number[t or ""]
        own = [i for i in ids[root[n]] if i is not None]
        copies = sum((x or "") == (t or "") for _, x in rows)
        out.append((min(own) if own else None, len(links[n]), copies))
    return out


def token_ids(text, tokenizer):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))

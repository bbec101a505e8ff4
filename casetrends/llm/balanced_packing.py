"""Token sequences of equal cost: linear plus quadratic work, longest documents first."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from casetrends.llm.common import col

# Letters below U+0250 are their own composed form and have one lower-case letter each, but for
# U+0130. A run of them is one piece of the pre-tokenizer where one of these marks follows.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ɏ"
SIMPLE = f"^(?P<word>[{LETTERS}]{{0,64}})(?P<marks>[.,;:!?]{{0,64}})$"
NONE = np.iinfo(np.int64).max
WORDS_AT_ONCE, RUNS_AT_ONCE = 1 << 16, 1 << 18
PIECES_AT_ONCE = 1024


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class WordMerges:
    """Byte pairs merged in all words at once: in each round every word merges its pair of lowest
    rank, the leftmost of equal ones, until no word has a pair of the vocabulary."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        letters = byte_letters()
        self.size = max(vocabulary.values()) + 1
        self.inside = np.array([vocabulary[x] for x in letters], np.int64)
        self.last = np.array([vocabulary[x + suffix] for x in letters], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        key = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in pairs], np.int64)
        self.rank = np.argsort(key, kind="stable")
        self.key = key[self.rank]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NONE)

    def encode(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, end to end, and how many each has. ``begins`` has one number more
        than there are words, none of them empty."""
        n = len(begins) - 1
        ids = self.inside[data]
        ids[begins[1:] - 1] = self.last[data[begins[1:] - 1]]
        word = np.repeat(np.arange(n), np.diff(begins))
        rank = np.full(len(ids), NONE)
        rank[:-1] = np.where(word[:-1] == word[1:], self.ranks(ids[:-1], ids[1:]), NONE)
        done = []
        while len(ids):
            fresh = np.concatenate([[True], word[1:] != word[:-1]])
            starts = np.flatnonzero(fresh)
            least = np.minimum.reduceat(rank, starts)
            slot = np.cumsum(fresh) - 1
            goes_on = (least != NONE)[slot]
            if not goes_on.all():
                done.append((word[~goes_on], ids[~goes_on]))
                ids, word, rank, slot = ids[goes_on], word[goes_on], rank[goes_on], slot[goes_on]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == least[slot])
            at = at[np.concatenate([[True], slot[at[1:]] != slot[at[:-1]]])]
            ids[at] = self.made[rank[at]]
            kept = np.ones(len(ids), bool)
            kept[at + 1] = False
            ids, word, rank = ids[kept], word[kept], rank[kept]
            at = at - np.arange(len(at))
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(ids) - 1)
                pair = (right > left) & (word[left] == word[right])
                rank[left] = np.where(pair, self.ranks(ids[left], ids[right]), NONE)
        if not done:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        word = np.concatenate([w for w, _ in done])
        order = np.argsort(word, kind="stable")
        return np.concatenate([i for _, i in done])[order], np.bincount(word, minlength=n)


class WordCoder:
    """Ids of texts, by their distinct words.

    The vocabulary drops white space before it cuts words, so the ids of a text are those of its
    runs between white space, one after another. Runs of plain letters, with or without the marks
    ``.,;:!?`` after them, are merged here, all distinct ones of a batch together; the tokenizer
    encodes any other run as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = WordMerges(model["vocab"], model["merges"], model["end_of_word_suffix"])

    def _wholes(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        made = self.tokenizer.encode_batch_fast(runs.to_pylist(), add_special_tokens=False)
        size = np.array([len(x.ids) for x in made], np.int64)
        return np.array([i for x in made for i in x.ids], np.int64), size

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for k in range(0, len(words), WORDS_AT_ONCE):
            _, offsets, data = words[k : k + WORDS_AT_ONCE].buffers()
            n = min(WORDS_AT_ONCE, len(words) - k)
            begins = np.frombuffer(offsets, np.int32)[k : k + n + 1].astype(np.int64)
            text = np.frombuffer(data or b"", np.uint8)[begins[0] : begins[-1]]
            size = np.diff(begins)
            if len(text):
                ids, size[size > 0] = self.merges.encode(text, np.unique(begins) - begins[0])
                flat.append(ids.astype("<u4"))
            sizes.append(size)
        return np.concatenate(flat), np.concatenate(sizes)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn."""
        runs = pc.ascii_split_whitespace(texts.fill_null(""))
        offsets = np.asarray(runs.offsets, np.int64) - runs.offsets[0].as_py()
        coded = runs.flatten().dictionary_encode()
        parts = pc.extract_regex(coded.dictionary, SIMPLE)
        simple = parts.is_valid().to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(pc.struct_field(parts, "word")).dictionary_encode()
        marks = pc.struct_field(parts, "marks").dictionary_encode()
        others = coded.dictionary.filter(pa.array(~simple, pa.bool_()))
        # Each run is two atoms: a word and its marks, or another run and nothing (the last atom).
        made = [self._words(words.dictionary), self._wholes(marks.dictionary), self._wholes(others)]
        size = np.concatenate([*[n for _, n in made], [0]])
        flat = np.concatenate([ids for ids, _ in made]).astype("<u4")
        begin = np.cumsum(size) - size
        n_words, n_marks = len(words.dictionary), len(marks.dictionary)
        first = np.where(
            simple, words.indices.fill_null(0).to_numpy(zero_copy_only=False),
            n_words + n_marks + np.cumsum(~simple) - 1,
        )
        second = np.where(
            simple, n_words + marks.indices.fill_null(0).to_numpy(zero_copy_only=False),
            len(size) - 1,
        )
        atoms = np.stack([first, second], 1)
        which = coded.indices.to_numpy(zero_copy_only=False)
        del runs, coded, parts, words, marks, others
        at = 0
        while at < len(texts):
            # Some texts at a time, as their ids take far more room than the numbers of their runs.
            until = max(at + 1, int(np.searchsorted(offsets, offsets[at] + RUNS_AT_ONCE)) - 1)
            own = atoms[which[offsets[at] : offsets[until]]].ravel()
            length = size[own]
            before = np.concatenate([[0], np.cumsum(length)])
            place = np.repeat(begin[own] - before[:-1], length)
            place += np.arange(before[-1])
            ids = flat[place]
            ends = before[2 * (offsets[at + 1 : until + 1] - offsets[at])]
            for low, high in zip([0, *ends[:-1]], ends):
                yield ids[low:high]
            at = until


def room_for(tokens: int, capacity: int) -> list[int]:
    """Sizes of sequences that the tokens fill to the last place: full ones, then powers of two."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [
        1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1
    ]


def balance(
    lengths: list[int], sizes: list[int], linear: float, quadratic: float
) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)``: where the pieces of the documents go.

    Documents go by descending length, the earlier one first among equal ones, each to the
    sequence of least cost that has room for it, the first of equal ones. One that fits nowhere
    fills up the cheapest open sequence, and its rest takes its turn by its own length. The sizes
    add up to the lengths, so every sequence ends full.
    """
    room = np.array(sizes, np.int64)
    cost = np.zeros(len(sizes))
    todo = [(-n, k, 0) for k, n in enumerate(lengths)]
    heapq.heapify(todo)
    out = []
    while todo:
        short, doc, start = heapq.heappop(todo)
        n = -short
        fits = room >= n
        if not fits.any():
            fits = room > 0
        best = int(np.where(fits, cost, np.inf).argmin())
        piece = min(n, int(room[best]))
        out.append((doc, start, piece, best, sizes[best] - int(room[best])))
        room[best] -= piece
        cost[best] += linear * piece + quadratic * piece * piece
        if piece < n:
            heapq.heappush(todo, (piece - n, doc, start + piece))
    return out


def pack_balanced(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    linear: float = 1.0,
    quadratic: float = 1 / 6144,
    group_sequences: int = 512,
) -> DataFrame:
    """``id, start, length, ids, doc_tokens, sequence_id, offset``: where each piece is.

    A document is the ids of its text, then ``end_id``; ``ids`` are a piece's ids as little-endian
    unsigned 32-bit numbers. A piece of n tokens costs ``linear * n + quadratic * n * n`` (the
    default weighs attention against the rest of a layer of width 1024).

    A task cuts full sequences off documents beyond ``capacity`` and balances the rest in groups of
    ``group_sequences``; the last document of a group is cut where the group is full. So
    sequences are full, but for at most one of each power of two below ``capacity`` at the end of
    a task, which need no padding. Nothing is shuffled, a task holds one group, and a task that
    runs again gives the same rows.

    NULL text is empty: one piece, ``end_id``. NULL and repeated ids are carried along, so are
    repeated rows; documents of equal length go in the order of the table; an empty table gives no
    rows; other columns are not looked at. A very long text is held once, and its ids.
    """
    id_kind = docs.schema[id_col].dataType.simpleString()
    names = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    limit = group_sequences * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordCoder(tokenizer_path)
        made = TaskContext.get().partitionId() << 33
        end = np.asarray([end_id], "<u4")
        waiting: list[tuple] = []  # id, start, ids, doc_tokens
        held, id_type = 0, None

        def rows_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * (len(names) + 1)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, [id_type, *kinds])],
                names=["id", *names],
            )

        def packed() -> pa.RecordBatch:
            nonlocal made, held
            sizes = room_for(held, capacity)
            rows = []
            for doc, start, n, sequence, offset in balance(
                [len(x[2]) for x in waiting], sizes, linear, quadratic
            ):
                name, base, ids, whole = waiting[doc]
                piece = ids[start : start + n].tobytes()
                rows.append((name, base + start, n, piece, whole, made + sequence, offset))
            made += len(sizes)
            waiting.clear()
            held = 0
            return rows_of(rows)

        for batch in batches:
            id_type = batch.column("id").type
            full = []
            names_of = batch.column("id").to_pylist()
            for name, ids in zip(names_of, coder.encode(batch.column("text"))):
                own = np.concatenate([ids, end])
                whole, at = len(own), 0
                while whole - at >= capacity:
                    piece = own[at : at + capacity].tobytes()
                    full.append((name, at, capacity, piece, whole, made, 0))
                    made, at = made + 1, at + capacity
                    if len(full) == PIECES_AT_ONCE:
                        yield rows_of(full)
                        full = []
                if at < whole:
                    n = min(whole - at, limit - held)
                    waiting.append((name, at, own[at : at + n].copy(), whole))
                    held += n
                    if held == limit:
                        yield packed()
                    if at + n < whole:
                        waiting.append((name, at + n, own[at + n :].copy(), whole))
                        held += whole - at - n
            yield rows_of(full)
        if waiting:
            yield packed()

    return docs.select(col(id_col).alias("id"), col(text_col).alias("text")).mapInArrow(
        run,
        f"id {id_kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long",
    )

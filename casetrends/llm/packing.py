"""Token sequences filled by best fit with a fixed number of open ones."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from casetrends.llm.common import col

SPECIAL = "<|endoftext|>"


def rank_encoder(
    ranks_path: str, pattern: str, special_id: int, tokenizer_path: str
) -> Callable[[str], np.ndarray]:
    """Token ids of a text, from a rank file. The special string is one token, as in the
    vocabulary's own definition.

    The pattern engine gives up on runs of some hundred thousand blanks or line ends; the
    tokenizer of the same vocabulary, which is slower, encodes such a text.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding(
        "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={SPECIAL: special_id}
    )
    whole = lru_cache(1)(Tokenizer.from_file)

    def encode(text: str) -> np.ndarray:
        try:
            if SPECIAL in text:
                return np.asarray(coder.encode(text, allowed_special="all"), "<u4")
            return np.frombuffer(coder.encode_to_numpy(text, allowed_special=set(),
                                                       disallowed_special=()), "<u4")
        except ValueError:
            ids = whole(tokenizer_path).encode(text, add_special_tokens=False).ids
            return np.asarray(ids, "<u4")

    return encode


class OpenBins:
    """At most ``limit`` open bins of one capacity.

    Bit ``f`` of ``free`` is set where an open bin has ``f`` places left, so the best fit for a
    piece of length n is the lowest set bit from n on. When a bin must close for a new one, the
    fullest does: the lowest set bit of all.
    """

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free, self.open, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.open -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        """The bin of a piece and its offset there."""
        fitting = self.free >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
            number, space = self.made, self.capacity
            self.made += 1
        left = space - length
        if left:
            self.bins[left].append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - space


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces: all full but the first, which takes the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    special_id: int = 50256,
    open_bins: int = 512,
) -> DataFrame:
    """``id, piece, start, length, ids, sequence_id, offset``: where each piece of a document is.

    A document is the ids of its text, then ``end_id``. Longer ones than ``capacity`` are cut;
    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers. Each task fills
    sequences of its own from its rows in turn, so nothing is shuffled, memory is ``open_bins``
    numbers, and a task that runs again gives the same rows.

    Every task leaves its last open sequences as they are, so the fill falls with the number of tasks
    (README has figures). Among sequences with equal room the one opened or filled last is taken.

    NULL text is empty: one piece of length 1. A very long text is held once, with its ids. NULL and repeated ids are carried along, a piece
    or more for each row. An empty table gives no rows. Other columns are not looked at.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["piece", "start", "length", "ids", "sequence_id", "offset"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = rank_encoder(ranks_path, pattern, special_id, tokenizer_path)
        bins = OpenBins(capacity, open_bins)
        base = TaskContext.get().partitionId() << 33
        end = np.asarray([end_id], "<u4")
        for batch in batches:
            source, rows = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.concatenate([encode(text), end]) if text else end
                for k, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    number, offset = bins.put(length)
                    piece = ids[start : start + length].tobytes()
                    source.append(i)
                    rows.append((k, start, length, piece, base + number, offset))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(source, pa.int64()))]
                + [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["id", *names],
            )

    return docs.select(col(id_col).alias("id"), col(text_col).alias("text")).mapInArrow(
        run,
        f"id {id_type}, piece int, start long, length long, ids binary, sequence_id long, "
        "offset long",
    )

"""Token counts by byte-pair merging with a heap and a linked list.

A piece of text starts as a linked list of byte symbols. A heap holds the
adjacent pairs that have a rank; the lowest is popped, its two symbols become
one, and the two new neighbour pairs are pushed. The count of a piece is its
symbols less its merges, so no token identifier is ever made.

Null and empty texts have no tokens; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberwall.llm.common import column_bytes, with_result

FIELDS = "n_bytes long, n_tokens long, over_limit boolean"

#: Pieces whose counts a task remembers before it starts anew.
REMEMBERED = 400_000


def byte_symbols() -> list[str]:
    """The character that stands for each byte value in byte-level vocabularies:
    itself if printable, else the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def count_merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many symbols are left when no adjacent pair has a rank."""
    n = len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [
        (rank, i, symbols[i], symbols[i + 1])
        for i in range(n - 1)
        if (rank := ranks.get((symbols[i], symbols[i + 1]))) is not None
    ]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, first, second = heapq.heappop(heap)
        j = right[i]
        if symbols[i] != first or j >= n or symbols[j] != second:
            continue  # one of the two was merged into something else
        merges += 1
        symbols[i], symbols[j] = first + second, ""
        after = right[i] = right[j]
        if after < n:
            left[after] = i
            rank = ranks.get((symbols[i], symbols[after]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, symbols[i], symbols[after]))
        before = left[i]
        if before >= 0:
            rank = ranks.get((symbols[before], symbols[i]))
            if rank is not None:
                heapq.heappush(heap, (rank, before, symbols[before], symbols[i]))
    return n - merges


class Counter:
    """Counts tokens with the merges, pattern and special strings of a tokenizer file."""

    def __init__(self, definition: str, pattern: str):
        import regex

        model = json.loads(definition)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(pairs)}
        self.symbols = byte_symbols()
        self.pieces = regex.compile(pattern).findall
        special = [t["content"] for t in model["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.strings = special
        self.known: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        count = self.known.get(piece)
        if count is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            count = count_merged([self.symbols[b] for b in piece.encode()], self.ranks)
            if len(piece) < 64:
                self.known[piece] = count
        return count

    def _plain(self, text: str) -> int:
        pieces = self.pieces(text)
        counts = list(map(self.known.get, pieces))
        if None in counts:
            return sum(map(self.piece, pieces))
        return sum(counts)

    def text(self, text: str) -> int:
        if self.special is None or not any(s in text for s in self.strings):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    text: str = "text",
    out: str = "tokens",
    keep: Sequence[str] | None = None,
    limit: int = 512,
) -> DataFrame:
    """``docs`` with a struct column ``out``: UTF-8 bytes, tokens, and whether
    the tokens are more than ``limit``.

    The tokenizer file is read on the driver and sent along; its size is that of
    a vocabulary, whatever the data.
    """
    at = docs.columns.index(text)
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def prepare():
        counter = Counter(definition.value, pattern)

        def compute(batch: pa.RecordBatch):
            texts = column_bytes(batch.column(at))
            counts = np.array(
                [counter.text(x.decode("utf-8", "replace")) for x in texts], np.int64
            )
            return [
                ("n_bytes", pa.array([len(x) for x in texts], pa.int64())),
                ("n_tokens", pa.array(counts)),
                ("over_limit", pa.array(counts > limit)),
            ]

        return compute

    return with_result(docs, out, FIELDS, prepare, keep)


def count_all(texts: Iterable[str], tokenizer_path: str, pattern: str) -> list[int]:
    """The same counts without Spark, for a few texts."""
    with open(tokenizer_path, encoding="utf-8") as file:
        counter = Counter(file.read(), pattern)
    return [counter.text(x) for x in texts]

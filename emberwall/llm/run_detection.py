"""Stretches of words that repeat with a period, found by internal pattern matching.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are
the same), of at least ``least`` words and ``times`` periods, that can't be made longer on
either side. Many documents are searched at once, by array operations:

1. The words of a chunk of documents get a suffix array by doubling: round ``k`` orders
   suffixes by their first ``2^k`` words and leaves alone those that are told apart
   already. The ranks of all rounds are kept; they tell in ``log n`` steps how far two
   places agree, forwards and backwards.
2. A wavelet tree over the suffix array answers range successor: the first place from
   ``x`` on where a word sequence, given by its range in the suffix array, occurs. It
   holds those suffixes only whose first two words occur again in their document.
3. Each document is cut into dyadic blocks of ``L`` = 2, 4, 8, ... words. A run of period
   ``L <= q < 2L`` (``q < 4`` for the first size) is at least four periods long, so it
   holds a whole block and the block's copy ``q`` words on. For each block its occurrences
   in the next ``2L`` words are looked up. Occurrences closer than ``L/2`` follow each
   other in an arithmetic progression with the block's own period; only its last member is
   needed, which the agreement of two of them gives, so at most five look-ups a block
   remain. Distances between last members are the candidate periods.
4. Each candidate is extended both ways by the ranks. Stretches found with several
   periods have the smallest of them.

A chunk is about 1 MB of text, or a single longer document; a task holds one chunk, about
150 bytes a word. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberwall.llm.common import column_bytes, with_result

CHUNK_BYTES = 1 << 20
#: Periods a run must hold; the search relies on four.
LEAST_TIMES = 4


@dataclass
class Words:
    """Words of some texts as numbers, equal for equal words."""

    number: np.ndarray
    offsets: np.ndarray  # where the words of each text begin; one more than texts
    first: np.ndarray  # per word, where its text begins
    last: np.ndarray  # per word, where its text ends (exclusive)

    @staticmethod
    def of(texts: Sequence[Sequence[bytes]]) -> Words:
        known: dict[bytes, int] = {}
        numbers = [known.setdefault(w, len(known)) for words in texts for w in words]
        sizes = np.array([len(words) for words in texts], np.int64)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        return Words(
            np.array(numbers, np.int64),
            offsets,
            np.repeat(offsets[:-1], sizes),
            np.repeat(offsets[1:], sizes),
        )


class Suffixes:
    """Suffix array of the texts, each by itself (the text is the first sign of all its
    suffixes), and the ranks by the first ``2^k`` words: where in the array the group of
    suffixes starts that agree so far."""

    def __init__(self, words: Words):
        n = len(words.number)
        self.words = words
        key = words.first * (int(words.number.max(initial=0)) + 1) + words.number
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        groups = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank = np.empty(n, np.int32)
        rank[order] = groups
        self.ranks = [rank]
        #: Per round, (place, start, end) of the suffixes in groups of two and more.
        self.shared: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        active = self._together(order, new, np.arange(n))
        step = 1
        while len(active):
            at = order[active]
            beyond = at + step
            # a text that has ended comes before all that go on, and is alone there
            second = np.where(beyond < words.last[at], rank[np.minimum(beyond, n - 1)] + 1, 0)
            key = rank[at].astype(np.int64) * (n + 1) + second
            by = np.argsort(key, kind="stable")
            order[active], key = at[by], key[by]
            new = np.ones(len(active), bool)
            new[1:] = key[1:] != key[:-1]
            rank = rank.copy()
            rank[order[active]] = np.maximum.accumulate(np.where(new, active, 0))
            self.ranks.append(rank)
            active = self._together(order, new, active)
            step *= 2
        self.order = order

    def _together(self, order: np.ndarray, new: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Places in the array of the suffixes in groups of two and more, which are noted."""
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(new)))
        many = np.repeat(sizes > 1, sizes)
        first = np.repeat(active[starts], sizes)[many]
        size = np.repeat(sizes, sizes)[many]
        kept = active[many]
        self.shared.append((order[kept].copy(), first, first + size))
        return kept

    def agree(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from ``x`` on are the same as from ``y`` on; ``x < y``, both in
        one text."""
        x, y, start = x.copy(), y.copy(), x
        last = self.words.last[x] if len(x) else x
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            inside = np.flatnonzero(y + (1 << k) <= last)
            same = inside[rank[x[inside]] == rank[y[inside]]]
            x[same] += 1 << k
            y[same] += 1 << k
        return x - start

    def agree_before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words before ``x`` are the same as before ``y``; ``x < y``."""
        x, y, start = x.copy(), y.copy(), x
        first = self.words.first[x] if len(x) else x
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, size = self.ranks[k], 1 << k
            inside = np.flatnonzero(x - size >= first)
            same = inside[rank[x[inside] - size] == rank[y[inside] - size]]
            x[same] -= size
            y[same] -= size
        return start - x


class WaveletTree:
    """A sequence of different numbers 0 to n - 1, in levels by bits from the highest;
    each level keeps how many zeros stand before each place."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.bits = max(1, int(self.size - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for shift in range(self.bits - 1, -1, -1):
            one = (values >> shift) & 1 == 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate((values[~one], values[one]))

    def count_below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of ``[low, high)`` are smaller than ``x``."""
        found = np.zeros(len(x), np.int64)
        whole = x >= 1 << self.bits
        for level, before in enumerate(self.zeros):
            one = (x >> (self.bits - 1 - level)) & 1 == 1
            a, b = before[low], before[high]
            found += np.where(one, b - a, 0)
            low = np.where(one, before[-1] + low - a, a)
            high = np.where(one, before[-1] + high - b, b)
        return np.where(whole, self.size, found)

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The number with ``rank`` smaller ones in ``[low, high)``."""
        value = np.zeros(len(rank), np.int64)
        for before in self.zeros:
            a, b = before[low], before[high]
            one = rank >= b - a
            rank = np.where(one, rank - (b - a), rank)
            low = np.where(one, before[-1] + low - a, a)
            high = np.where(one, before[-1] + high - b, b)
            value = 2 * value + one
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest number of ``[low, high)`` that is not below ``x``; -1 if none."""
        below = self.count_below(low, high, x)
        out = np.full(len(x), -1, np.int64)
        some = np.flatnonzero(below < high - low)
        out[some] = self.smallest(low[some], high[some], below[some])
        return out


class Occurrences:
    """Where blocks occur: range successor over the suffixes that share two words."""

    def __init__(self, suffixes: Suffixes):
        n = len(suffixes.order)
        places, _, _ = suffixes.shared[1]
        held = np.zeros(n, bool)
        held[places] = True
        self.places = np.flatnonzero(held)
        self.number = np.concatenate(([0], np.cumsum(held)))
        in_order = held[suffixes.order]
        self.rank = np.concatenate(([0], np.cumsum(in_order)))
        self.tree = WaveletTree(self.number[suffixes.order[in_order]])

    def next(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The first place from ``x`` on with a suffix in the range; -1 if none."""
        x = np.minimum(x, len(self.number) - 1)
        found = self.tree.successor(self.rank[low], self.rank[high], self.number[x])
        return np.where(found >= 0, self.places[found], -1)


def candidates(words: Words, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): places that may lie in a run of that period."""
    blocks = []
    for k in range(1, len(suffixes.shared)):
        place, low, high = suffixes.shared[k]
        size = 1 << k
        inside = place - words.first[place]
        room = words.last[place] - words.first[place] >= LEAST_TIMES * (size if k > 1 else 1)
        chosen = (inside % size == 0) & room
        if chosen.any():
            blocks.append(
                (place[chosen], low[chosen], high[chosen], np.full(chosen.sum(), size))
            )
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, low, high, size = (np.concatenate(x).astype(np.int64) for x in zip(*blocks))
    occurrences = Occurrences(suffixes)
    found_at, found_period = [], []

    def last_member(at, low, high, size):
        """The last of the progression of occurrences that starts at ``at``; and its step,
        0 if there is none."""
        after = occurrences.next(low, high, at + 1)
        step = np.where((after >= 0) & (2 * (after - at) <= size), after - at, 0)
        many = np.flatnonzero(step)
        last = at.copy()
        agree = suffixes.agree(at[many], at[many] + step[many])
        last[many] += step[many] * ((step[many] + agree - size[many]) // step[many])
        return last, step

    last, step = last_member(at, low, high, size)
    single = step == 1  # one word again and again: the smallest period of the first size
    found_at.append(at[single])
    found_period.append(step[single])
    here = last
    while len(here):
        after = occurrences.next(low, high, here + 1)
        near = np.flatnonzero((after >= 0) & (after - last < 2 * size))
        last, low, high, size, after = (x[near] for x in (last, low, high, size, after))
        if not len(near):
            break
        here, _ = last_member(after, low, high, size)
        period = here - last
        least = np.where(size == 2, 1, size)
        fits = (period >= least) & (period < 2 * size)
        found_at.append(last[fits])
        found_period.append(period[fits])
    return np.concatenate(found_at), np.concatenate(found_period)


def runs_of(
    texts: Sequence[Sequence[bytes]], least: int = 6, times: int = 4
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period."""
    none = (np.zeros(0, np.int64),) * 4
    words = Words.of(texts)
    if not len(words.number):
        return none
    suffixes = Suffixes(words)
    if len(suffixes.shared) < 2:
        return none
    at, period = candidates(words, suffixes)
    forward = suffixes.agree(at, at + period)
    start = at - suffixes.agree_before(at, at + period)
    length = at + period + forward - start
    long = length >= np.maximum(least, times * period)
    start, length, period = start[long], length[long], period[long]
    # one stretch, one run: that of the smallest period
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    owner = np.searchsorted(words.offsets, start, side="right") - 1
    return owner, start - words.first[start], length, period


def collapsed(words: Sequence[bytes], start, length, period) -> bytes:
    """The words joined by a space, without those that a run holds after its first
    period."""
    if not len(start):
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, start + period, 1)
    np.add.at(marks, start + length, -1)
    kept = np.flatnonzero(np.cumsum(marks[:-1]) == 0)
    return b" ".join([words[i] for i in kept])


def _chunks(texts: list[bytes]):
    """(first, last) of chunks of whole texts."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK_BYTES:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def find_runs(
    docs: DataFrame,
    text: str = "text",
    out: str = "repetition",
    keep: Sequence[str] | None = None,
    least: int = 6,
    times: int = 4,
) -> DataFrame:
    """``docs`` with a struct ``out``: ``n_words``, ``runs`` (an array of ``start`` (word
    number), ``length``, ``period``, by start, then period) and ``collapsed``, the text as
    words joined by a space, without the words a run holds after its first period.

    Words are runs of bytes other than space and \\x09 to \\x0D and are compared as bytes.
    Null texts are empty: no words, no runs, an empty ``collapsed``. Rows, repeated ones
    too, are treated each by itself; equal texts have equal results. The result is a
    struct of its own, so names in ``docs`` don't clash. ``times`` must be at least 4.
    """
    if times < LEAST_TIMES:
        raise ValueError(f"runs of less than {LEAST_TIMES} periods are not found by this search")
    at = docs.columns.index(text)
    fields = (
        "n_words long, runs array<struct<start: long, length: long, period: long>>, "
        "collapsed string"
    )

    def prepare():
        def compute(batch: pa.RecordBatch):
            texts = column_bytes(batch.column(at))
            counts, offsets, shown = [], [0], []
            found: list[list[np.ndarray]] = [[], [], []]
            for first, last in _chunks(texts):
                split = [x.split() for x in texts[first:last]]
                owner, *values = runs_of(split, least, times)
                edges = np.searchsorted(owner, np.arange(len(split) + 1))
                for words, a, b in zip(split, edges, edges[1:]):
                    counts.append(len(words))
                    shown.append(collapsed(words, *[v[a:b] for v in values]))
                offsets += (offsets[-1] + edges[1:]).tolist()
                for column, own in zip(found, values):
                    column.append(own)
            values = [
                pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64())
                for c in found
            ]
            runs = pa.StructArray.from_arrays(values, ["start", "length", "period"])
            return [
                ("n_words", pa.array(counts, pa.int64())),
                ("runs", pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs)),
                ("collapsed", pa.array([x.decode("utf-8", "replace") for x in shown], pa.string())),
            ]

        return compute

    return with_result(docs, out, fields, prepare, keep)

"""Near-duplicates by SimHash, found with an index of byte positions.

A fingerprint of 64 bits is eight bytes at eight positions. Two fingerprints that
differ in at most ``d`` bits differ in at most ``d`` bytes, so they share at least
8 - d bytes in place: the guaranteed minimum of matches. The index has lists of
fingerprints with the same five bytes in place, for a few choices of five
positions such that every allowed difference leaves one choice untouched. Within
a list the shared positional bytes of a pair are tallied, pairs below the minimum
are dropped, and the rest are verified by their differing bits.

Only different fingerprints are indexed, so exact copies cost nothing. A list
fixes 40 of 64 bits, so it has at most 2^24 entries whatever the data; in a long
one, partners are looked up by flipping the allowed bits, so its cost grows with
its length, not with the square. Lists pass on a forest of links, not all pairs.

A text without words has fingerprint zero. Null texts are empty; null ids take part
but are never the id of a component unless all its ids are null; repeated rows stay
and get the same component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwall.llm.common import (
    Rows, column_bytes, free_name, map_batches, shuffle_parts, with_result,
)
from emberwall.llm.components import components, forest
from emberwall.llm.words import LOWER
from emberwall.session import store, store_sized

BYTES = 8
FREE = 3  # positions a list does not fix
#: Lists up to this length compare all their pairs.
SHORT_LIST = 300
SEED = 42


def fingerprint(text: bytes, shingle: int = 3, at_once: int = 1 << 16) -> int:
    """The SimHash of a text over its word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for k in range(0, n, at_once):
        spans = zip(starts[k : k + at_once], stops[k : k + at_once])
        hashes = [xxh64_intdigest(joined[i:j], SEED) for i, j in spans]
        raw = np.array(hashes, "<u8").view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def fingerprints(
    docs: DataFrame,
    text: str = "text",
    out: str = "simhash",
    keep: Sequence[str] | None = None,
    shingle: int = 3,
) -> DataFrame:
    """``docs`` with a struct column ``out``: the ``fingerprint``, as a signed long."""
    at = docs.columns.index(text)

    def prepare():
        def compute(batch: pa.RecordBatch):
            found = [fingerprint(x, shingle) for x in column_bytes(batch.column(at))]
            signed = np.array(found, np.uint64).view(np.int64)
            return [("fingerprint", pa.array(signed))]

        return compute

    return with_result(docs, out, "fingerprint long", prepare, keep)


def free_positions(differing: int) -> list[tuple[int, ...]]:
    """Sets of ``FREE`` positions so that any ``differing`` positions lie in one of
    them: each time the set that takes in most of what is not yet covered."""
    open_ = set(combinations(range(BYTES), differing))
    sets = list(combinations(range(BYTES), FREE))
    chosen = []
    while open_:
        best = max(sets, key=lambda s: len(open_ & set(combinations(s, differing))))
        chosen.append(best)
        open_ -= set(combinations(best, differing))
    return chosen


def _fixed_mask(free: tuple[int, ...]) -> int:
    """The bits of all other positions, as a signed long."""
    bits = sum(0xFF << (8 * p) for p in range(BYTES) if p not in free)
    return bits - (1 << 64) if bits >> 63 else bits


def _flips(free: tuple[int, ...], most: int) -> np.ndarray:
    bits = [8 * p + k for p in free for k in range(8)]
    masks = [sum(1 << b for b in c) for n in range(1, most + 1) for c in combinations(bits, n)]
    return np.array(masks, np.uint64)


class Links:
    """Links of pairs, cut down to a forest whenever there are many."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.size = most, 0
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.held.append((a, b))
        self.size += len(a)
        if self.size > self.most:
            cut = self.forest()
            self.held, self.size = [cut], 0

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, np.int64)
        a = np.concatenate([none, *[x for x, _ in self.held]])
        b = np.concatenate([none, *[x for _, x in self.held]])
        return forest(a, b)


def verify(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Which pairs share at least the guaranteed positional bytes and differ in at
    most ``most`` bits."""
    differ = a ^ b
    shared = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    found = np.flatnonzero(shared >= BYTES - most)
    return found[np.bitwise_count(differ[found]) <= most]


def link_lists(
    slot: np.ndarray, key: np.ndarray, value: np.ndarray, most: int, links: Links
) -> None:
    """Add the links of all lists; ``slot`` and ``key`` tell lists apart."""
    order = np.lexsort((value, key, slot))
    slot, key, value = slot[order], key[order], value[order]
    edge = np.ones(len(key) + 1, bool)
    edge[1:-1] = (slot[1:] != slot[:-1]) | (key[1:] != key[:-1])
    first = np.flatnonzero(edge)
    length = np.diff(first)
    unsigned = value.view(np.uint64)

    short = (length > 1) & (length <= SHORT_LIST)
    begin, stop = first[:-1][short], first[1:][short]
    step = 1
    while len(begin):
        # element i of a list with element i + step, all lists at once
        n = stop - begin - step
        begin, stop, n = begin[n > 0], stop[n > 0], n[n > 0]
        if not len(begin):
            break
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i = np.repeat(begin, n) + offset
        good = verify(unsigned[i], unsigned[i + step], most)
        links.add(value[i[good]], value[i[good] + step])
        step += 1

    sets = free_positions(most)
    for start, n in zip(first[:-1][length > SHORT_LIST], length[length > SHORT_LIST]):
        own = np.sort(unsigned[start : start + n])
        for mask in _flips(sets[slot[start]], most):
            wanted = own ^ mask
            at = np.minimum(np.searchsorted(own, wanted), n - 1)
            met = (own[at] == wanted) & (own < wanted)
            links.add(own[met].view(np.int64), wanted[met].view(np.int64))


def near_links(prints: DataFrame, column: str, most: int = 2) -> DataFrame:
    """Links (``a``, ``b``) that connect the different values of ``column`` which
    differ in at most ``most`` bits, through others of its values or directly."""
    if not 1 <= most <= FREE:
        raise ValueError(f"most must be from 1 to {FREE}")
    value = F.col(f"`{column}`")
    lists = [
        F.struct(
            F.lit(k).alias("slot"),
            value.bitwiseAND(F.lit(_fixed_mask(free)).cast("long")).alias("key"),
            value.alias("value"),
        )
        for k, free in enumerate(free_positions(most))
    ]
    entries = prints.select(F.inline(F.array(*lists)))

    def run(batches: Rows) -> Rows:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns = [table.column(i).to_numpy() for i in range(3)]
        links = Links()
        link_lists(*columns, most, links)
        a, b = links.forest()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    lists = entries.repartition(shuffle_parts(prints), "slot", "key")
    return map_batches(lists, run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    out: str = "simhash",
    keep: Sequence[str] | None = None,
    shingle: int = 3,
    most: int = 2,
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``fingerprint``, ``component_id`` (the
    smallest id of all documents linked to it, itself included) and ``keeps``, true
    for one row of each component: the one with the smallest id.

    Fingerprints are made once and stored in the shared folder with a row number.
    """
    made, row = free_name(docs, "made"), free_name(docs, "row")
    rows = fingerprints(docs, text, made, keep, shingle)
    kept = [c for c in rows.columns if c != made]
    rows = rows.withColumn(row, F.monotonically_increasing_id())
    rows, _ = store_sized(rows, "fingerprints", "zstd")
    value = F.col(f"`{made}`.fingerprint")

    # smallest id first, null ids last, then the row written first
    first = F.struct(
        F.col(f"`{id_column}`").isNull().alias("unknown"),
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{row}`").alias("row"),
    )
    prints = store(rows.groupBy(value.alias("value")).agg(F.min(first).alias("first")), "prints")
    roots = components(near_links(prints.select("value"), "value", most))
    whole = prints.join(roots, prints["value"] == roots["node"], "left").select(
        "value", "first", F.coalesce("root", "value").alias("root")
    )
    groups = whole.groupBy("root").agg(F.min("first").alias("leader"))
    key, leader = free_name(rows, "value"), free_name(rows, "leader")
    found = whole.join(groups, "root").select(
        F.col("value").alias(key), F.col("leader").alias(leader)
    )
    joined = rows.join(found, value == F.col(f"`{key}`"))
    return joined.select(
        *[F.col(f"`{c}`") for c in kept],
        F.struct(
            value.alias("fingerprint"),
            F.col(f"`{leader}`.id").alias("component_id"),
            (F.col(f"`{leader}`.row") == F.col(f"`{row}`")).alias("keeps"),
        ).alias(out),
    )

"""Removal of repeated passages by prefix-free parsing.

A passage is a string of ``length`` bytes; it repeats if it starts at two places of
the corpus, in one text or in two. Every byte covered by a repeated passage is
removed; passages never cross texts and are judged on the input.

1. Parse. A rolling hash of eight bytes triggers at about every ``1 / rate``-th place.
   A phrase runs from one trigger through the next. What triggers depends on the
   bytes inside a passage only, so equal passages hold equal phrases.
2. Phrases are counted over the corpus. A passage with a phrase that occurs once
   can't repeat, and in text that isn't copied nearly all are settled so.
3. Passages are grouped by the phrases they hold in full, their run. What lies before
   and after the run is the end of one phrase and the beginning of another. Equal
   surroundings of a run are one entry. In each group, the suffix array of the
   dictionary of the phrase ends and the order of the parse (run, then the phrase
   that follows) give the corpus order of the passages; neighbours in it that agree
   over their whole length repeat.
4. Passages with no full phrase are grouped by a hash of their own. So are passages all
   of whose phrases are in more than ``HOT_BLOCKS`` blocks, as a run that many texts
   share has about as many surroundings, too many for one shard.

Blocks of texts stay where they are stored. They send phrase hashes, then entries, to
shards by hash, and get bits back, so what moves is a part of the text, and copies
inside a block move once. Hashes have 64 bits; texts that agree in a hash but not in
bytes are not told apart.

Null texts are empty; texts shorter than a passage lose nothing. Repeated rows are
copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwall.llm.common import (
    Rows, ask_shards, block_rows, column_bytes, map_batches, pack_blocks, replies, struct_of,
)
from emberwall.llm.words import Hasher, mix

GRAM = 8
#: Triggers are places whose hash is below 2^64 times this.
RATE = 1 / 24
#: Runs whose phrases are all in more blocks are split by passage. The entries of any
#: other run come from so many blocks at most, however large the corpus.
HOT_BLOCKS = 32
DIGESTS = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
TEXTS = (
    "n_bytes long, n_removed long, n_spans long, "
    "spans array<struct<start:long,end:long>>, kept binary"
)
_ALONE = np.uint64(0x5851F42D4C957F2D)


@dataclass
class Parse:
    """The triggers and phrases of the texts of a block that are long enough."""

    data: np.ndarray
    offsets: np.ndarray
    sums: np.ndarray
    hasher: Hasher
    length: int
    triggers: np.ndarray
    owner: np.ndarray  # text of each trigger
    phrases: np.ndarray  # hash of the phrase from each trigger to the next
    whole: np.ndarray  # whether that next trigger is in the same text

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.hasher.spans(self.sums, starts, ends)


def parse(texts: list[bytes], hasher: Hasher, length: int) -> Parse:
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in texts], dtype=np.int64)))
    if len(data) >= GRAM:
        grams = np.ndarray(len(data) - GRAM + 1, "<u8", joined, strides=(1,))
        rolled = grams * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(29)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        triggers = np.flatnonzero(rolled < np.uint64(int(2**64 * RATE)))
        del rolled
    else:
        triggers = np.zeros(0, np.int64)
    owner = np.searchsorted(offsets, triggers, "right") - 1
    long_enough = np.diff(offsets)[owner] >= length
    inside = triggers + GRAM <= offsets[owner + 1]
    triggers, owner = triggers[inside & long_enough], owner[inside & long_enough]
    sums = hasher.sums(data)
    whole = np.zeros(len(triggers), bool)
    phrases = np.zeros(len(triggers), np.uint64)
    if len(triggers) > 1:
        whole[:-1] = owner[1:] == owner[:-1]
        at = np.flatnonzero(whole)
        phrases[at] = hasher.spans(sums, triggers[at], triggers[at + 1] + GRAM)
    return Parse(data, offsets, sums, hasher, length, triggers, owner, phrases, whole)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys in order, whether each occurs twice, and which one each is."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    number = np.cumsum(first) - 1
    at = np.empty(len(keys), np.int64)
    at[order] = number
    values = ranked[first]
    return values, np.bincount(number, minlength=len(values)) > 1, at


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the keys of each shard begin among keys in order; one more than shards."""
    edges = [(i << 64) // shards for i in range(1, shards)]
    inner = np.searchsorted(keys, np.array(edges, np.uint64))
    return np.concatenate(([0], inner, [len(keys)])).astype(np.int64)


@dataclass
class Entries:
    """Surroundings of runs, as sent to shards: ``key`` of the run; windows of ``left``
    down to ``least`` bytes before it; ``right`` bytes after it for the last window."""

    key: np.ndarray
    left: np.ndarray
    least: np.ndarray
    right: np.ndarray
    begin: np.ndarray  # of the left part, in ``data``
    after: np.ndarray  # where the right part begins
    again: np.ndarray  # more than once in the block


def segments(p: Parse, repeated: np.ndarray, hot: np.ndarray):
    """Stretches [start, end) of window starts that hold the same run, all of whose
    phrases are repeated and not all hot, with the first and last trigger of the run;
    and the starts of windows with no full phrase or with a run of hot phrases."""
    length, t = p.length, p.triggers
    none = np.zeros(0, np.int64)
    low, high = p.offsets[:-1], p.offsets[1:] - length  # last window start, included
    fits = high >= low
    low, high = low[fits], high[fits]
    if not len(low):
        return none, none, none, none, none
    reach = length - GRAM
    cuts = np.concatenate([t + 1, t - reach])
    text = np.searchsorted(low, cuts, "right") - 1
    good = (text >= 0) & (cuts <= high[np.maximum(text, 0)])
    starts = np.unique(np.concatenate([low, cuts[good]]))
    text = np.searchsorted(low, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], high[-1] + 1), high[text] + 1)
    first = np.searchsorted(t, starts)
    last = np.searchsorted(t, starts + reach, "right") - 1
    run = last > first
    once = np.concatenate(([0], np.cumsum(p.whole & ~repeated)))
    clean = np.zeros(len(starts), bool)
    clean[run] = once[last[run]] == once[first[run]]
    cold = np.concatenate(([0], np.cumsum(p.whole & ~hot)))
    alone = ~run
    alone[run] = clean[run] & (cold[last[run]] == cold[first[run]])
    clean &= ~alone
    bare_starts, bare_ends = starts[alone], ends[alone]
    n = bare_ends - bare_starts
    bare = np.repeat(bare_starts - np.cumsum(n) + n, n) + np.arange(n.sum())
    return starts[clean], ends[clean], first[clean], last[clean], bare


def entries(p: Parse, repeated: np.ndarray, hot: np.ndarray) -> tuple[Entries, tuple]:
    """Different entries of a block in order of their key, and for each stretch or
    bare window where it starts, how many windows it has, and its entry."""
    start, end, first, last, bare = segments(p, repeated, hot)
    t = p.triggers
    run_start, run_end = t[first], t[last] + GRAM
    key = np.concatenate(
        [mix(p.hashes(run_start, run_end) + np.uint64(1)),
         mix(p.hashes(bare, bare + p.length) ^ _ALONE)]
    )
    full = mix(p.hashes(start, end - 1 + p.length) + (run_start - start).astype(np.uint64))
    place = np.concatenate([start, bare])
    windows = np.concatenate([end - start, np.ones(len(bare), np.int64)])
    left = np.concatenate([run_start - start, np.zeros(len(bare), np.int64)])
    after = np.concatenate([run_end, bare])
    right = np.concatenate([end - 1 + p.length - run_end, np.zeros(len(bare), np.int64)])
    around = np.concatenate([full, np.zeros(len(bare), np.uint64)])

    order = np.lexsort((around, key))
    new = np.ones(len(order), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (around[order][1:] != around[order][:-1])
    number = np.cumsum(new) - 1
    which = np.empty(len(order), np.int64)
    which[order] = number
    pick = order[new]
    again = np.bincount(number, minlength=len(pick)) > 1
    least = left[pick] - windows[pick] + 1
    found = Entries(
        key[pick], left[pick], np.maximum(least, 0), right[pick], place[pick], after[pick], again
    )
    return found, (place, windows, which)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


def suffix_ranks(data: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """The suffix array of a dictionary as ranks: for every place of ``data`` the rank
    of the string from there to the end of its word, equal strings alike. Ranks of
    1, 2, 4, ... bytes are doubled until ``most`` bytes are ordered."""
    n = len(data)
    rank = np.append(data.astype(np.int64) + 1, 0)
    at = np.arange(n)
    step = 1
    while step < most:
        beyond = at + step
        follow = np.where(beyond < ends, rank[np.minimum(beyond, n)], 0)
        pair = rank[:n] * (int(rank.max()) + 1) + follow
        order = np.argsort(pair)
        ranked = pair[order]
        number = np.ones(n, np.int64)
        number[1:] = ranked[1:] != ranked[:-1]
        rank[order] = np.cumsum(number)
        step *= 2
    return rank[:n]


def repeated_windows(
    key: np.ndarray, left: np.ndarray, least: np.ndarray, right: np.ndarray,
    again: np.ndarray, blob: np.ndarray, hasher: Hasher,
) -> np.ndarray:
    """One flag per window of every entry, entries in order, windows from the longest
    left part down. ``blob`` has the left and right bytes of the entries in order."""
    sizes = left + right
    begin = np.concatenate(([0], np.cumsum(sizes)))
    sums = hasher.sums(blob)
    around = hasher.spans(sums, begin[:-1], begin[1:])
    around = mix(around + left.astype(np.uint64) * np.uint64(257) + least.astype(np.uint64))
    order = np.lexsort((around, key))
    k, a = key[order], around[order]
    new_key, new = np.ones(len(k), bool), np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    new[1:] = new_key[1:] | (a[1:] != a[:-1])
    context = np.cumsum(new) - 1  # of entries in order
    group = np.cumsum(new_key) - 1
    times = np.bincount(context, weights=1 + again[order])
    several = np.bincount(group[new])[group[new]] > 1  # contexts per run
    chosen = order[new]  # one entry per context
    windows = left - least + 1

    # contexts that share a run with others: one element per window
    open_ = np.flatnonzero(several)
    own = chosen[open_]
    n = windows[own]
    flags = np.zeros(int(n.sum()), bool)
    if len(own):
        element = np.repeat(np.arange(len(own)), n)
        before = np.repeat(left[own], n) - (np.arange(len(element)) - np.repeat(np.cumsum(n) - n, n))
        after = right[own][element] + least[own][element] - before

        # dictionary: the left parts and, to order what follows, the right parts
        dictionary_of = ranges(begin[own], sizes[own])
        words = blob[dictionary_of]
        base = np.cumsum(sizes[own]) - sizes[own]
        ends = np.where(
            np.arange(len(words)) < np.repeat(base + left[own], sizes[own]),
            np.repeat(base + left[own], sizes[own]),
            np.repeat(base + sizes[own], sizes[own]),
        )
        ranks = np.append(suffix_ranks(words, ends, int(sizes[own].max(initial=1))), 0)
        ending = np.where(before > 0, ranks[base[element] + left[own][element] - before], 0)
        follows = np.where(right[own] > 0, ranks[np.minimum(base + left[own], len(words))], 0)

        # corpus order: end of the phrase before, run, phrase after
        rows = np.lexsort((follows[element], group[new][open_][element], before, ending))
        e, b, y = element[rows], before[rows], after[rows]
        same = (ending[rows][1:] == ending[rows][:-1]) & (b[1:] == b[:-1])
        same &= (group[new][open_][e][1:] == group[new][open_][e][:-1]) & (y[1:] == y[:-1])
        start = begin[own][e] + left[own][e]
        prefix = hasher.spans(sums, start, start + y)
        same &= prefix[1:] == prefix[:-1]
        flags[rows[1:]] |= same
        flags[rows[:-1]] |= same

    by_context = np.zeros(len(chosen), np.int64)
    by_context[open_] = np.cumsum(n) - n
    out = np.zeros(int(windows.sum()), bool)
    at = np.cumsum(windows) - windows
    whole = np.zeros(len(key), bool)
    whole[order] = times[context] > 1
    of = np.empty(len(key), np.int64)
    of[order] = context
    is_open = several[of] & ~whole
    out[ranges(at[whole], windows[whole])] = True
    out[ranges(at[is_open], windows[is_open])] = flags[
        ranges(by_context[of[is_open]], windows[is_open])
    ]
    return out


def _bits(raw: list[dict] | None, sizes: np.ndarray) -> np.ndarray:
    """The flags of a block from what the shards sent, in the order of the shards."""
    held = {x["shard"]: x["reply"] for x in raw or []}
    parts = [
        np.unpackbits(np.frombuffer(held[s], np.uint8), count=n).astype(bool)
        for s, n in enumerate(sizes.tolist())
        if n
    ]
    return np.concatenate([np.zeros(0, bool), *parts])


def _covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:n]) > 0


class Block:
    """The two messages of a block and what comes of the answers."""

    def __init__(self, texts: list[bytes], hasher: Hasher, length: int, shards: int):
        self.texts, self.shards = texts, shards
        self.parse = parse(texts, hasher, length)
        p = self.parse
        self.values, self.again, self.at = distinct(p.phrases[p.whole])
        self.bounds = shard_bounds(self.values, shards)

    def phrase_message(self):
        for s in np.flatnonzero(np.diff(self.bounds)).tolist():
            part = slice(self.bounds[s], self.bounds[s + 1])
            yield s, self.values[part].tobytes(), np.packbits(self.again[part]).tobytes()

    def learn_phrases(self, answer) -> None:
        # of each shard first which phrases are repeated, then which are hot
        sizes = np.diff(self.bounds)
        known = _bits(answer, 2 * sizes)
        place = np.arange(len(self.values))
        repeated, hot = np.zeros((2, len(self.parse.phrases)), bool)
        repeated[self.parse.whole] = known[place + np.repeat(self.bounds[:-1], sizes)][self.at]
        hot[self.parse.whole] = known[place + np.repeat(self.bounds[1:], sizes)][self.at]
        self.entries, self.stretches = entries(self.parse, repeated, hot)
        self.entry_bounds = shard_bounds(self.entries.key, self.shards)

    def entry_message(self):
        x = self.entries
        for s in np.flatnonzero(np.diff(self.entry_bounds)).tolist():
            part = slice(self.entry_bounds[s], self.entry_bounds[s + 1])
            left, right = x.left[part], x.right[part]
            starts = np.column_stack([x.begin[part], x.after[part]]).ravel()
            lengths = np.column_stack([left, right]).ravel()
            shape = np.column_stack([left, x.least[part], right, x.again[part]])
            yield (
                s, x.key[part].tobytes(), shape.astype(np.uint8).tobytes(),
                self.parse.data[ranges(starts, lengths)].tobytes(),
            )

    def removed(self, answer) -> np.ndarray:
        """Which bytes of the block are covered by a repeated passage."""
        x = self.entries
        windows = x.left - x.least + 1
        first = np.concatenate(([0], np.cumsum(windows)))
        sizes = np.diff(first[self.entry_bounds])
        flags = _bits(answer, sizes)
        place, n, which = self.stretches
        hit = flags[ranges(first[which], n)]
        starts = ranges(place, n)[hit]
        return _covered(len(self.parse.data), starts, self.parse.length)


def _split_bits(table: pa.Table, flags: np.ndarray, sizes: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    bits = [
        np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends.tolist(), sizes.tolist())
    ]
    return replies(table, bits)


def count_phrases(table: pa.Table) -> pa.Table:
    """Which phrases of each message occur more than once in all messages, then which
    are in more than ``HOT_BLOCKS`` messages."""
    values = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
    sizes = np.array([len(x) for x in values])
    again = [
        np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool)
        for x, n in zip(table.column("again").to_pylist(), sizes.tolist())
    ]
    key, twice = np.concatenate(values), np.concatenate(again)
    different, repeated, at = distinct(key)
    in_one = np.zeros(len(different), bool)
    in_one[at[twice]] = True
    hot = np.bincount(at, minlength=len(different)) > HOT_BLOCKS
    starts = np.cumsum(sizes) - sizes
    both = np.concatenate([(repeated | in_one)[at], hot[at]])
    order = ranges(
        np.column_stack([starts, starts + len(at)]).ravel(), np.repeat(sizes, 2)
    )
    return _split_bits(table, both[order], 2 * sizes)


def compare_entries(table: pa.Table) -> pa.Table:
    """Which windows of each message are repeated in all messages."""
    keys = [np.frombuffer(x, np.uint64) for x in table.column("keys").to_pylist()]
    shapes = np.frombuffer(b"".join(table.column("shapes").to_pylist()), np.uint8)
    left, least, right, again = shapes.reshape(-1, 4).astype(np.int64).T
    blob = np.frombuffer(b"".join(table.column("blob").to_pylist()), np.uint8)
    flags = repeated_windows(
        np.concatenate(keys), left, least, right, again, blob, Hasher()
    )
    ends = np.cumsum([len(x) for x in keys])
    windows = np.concatenate(([0], np.cumsum(left - least + 1)))
    sizes = windows[ends] - windows[np.concatenate(([0], ends[:-1]))]
    return _split_bits(table, flags, sizes)


def spans_of(mask: np.ndarray) -> np.ndarray:
    """Maximal runs of set places, as rows (start, end)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges.reshape(-1, 2)


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    out: str = "repeats",
    keep: Sequence[str] | None = None,
    length: int = 200,
    digests: bool = False,
    block_bytes: int = 1 << 22,
) -> DataFrame:
    """``docs`` (of its columns those in ``keep``, by default all) with a struct column
    ``out``: bytes, bytes removed, maximal removed runs, and the runs and what is left
    as bytes; with ``digests`` SHA-256 of what is left instead of these two.

    ``block_bytes`` of text are parsed at a time, in about 60 times as much memory.
    """
    if not GRAM * 2 < length < 256:
        raise ValueError("length must be over 16 and under 256")
    keep = list(docs.columns) if keep is None else list(keep)
    needed = [c for c in docs.columns if c in keep or c == text]
    docs = docs.select(*[F.col(f"`{c}`") for c in needed])
    blocks, shards = pack_blocks(docs, text, block_bytes)
    texts = blocks.select("block", F.col(f"docs.`{text}`").alias("texts"))

    def built(row_texts: pa.Array, hasher: Hasher) -> Block:
        return Block(column_bytes(row_texts.flatten()), hasher, length, shards)

    def send_phrases(batches: Rows) -> Rows:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                rows = list(built(batch.column(1).slice(i, 1), hasher).phrase_message())
                if rows:
                    shard, keys, again = zip(*rows)
                    block = batch.column(0)[i].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * len(rows), pa.int64()),
                         pa.array(shard, pa.int32()), pa.array(keys, pa.binary()),
                         pa.array(again, pa.binary())],
                        ["block", "shard", "keys", "again"],
                    )

    messages = map_batches(
        texts, send_phrases, "block long, shard int, keys binary, again binary"
    )
    phrases = ask_shards(messages, count_phrases, "phrases")

    def send_entries(batches: Rows) -> Rows:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                block = built(batch.column(1).slice(i, 1), hasher)
                block.learn_phrases(batch.column(2)[i].as_py())
                rows = list(block.entry_message())
                if rows:
                    shard, keys, shapes, blob = zip(*rows)
                    number = batch.column(0)[i].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([number] * len(rows), pa.int64()),
                         pa.array(shard, pa.int32()), pa.array(keys, pa.binary()),
                         pa.array(shapes, pa.binary()), pa.array(blob, pa.binary())],
                        ["block", "shard", "keys", "shapes", "blob"],
                    )

    known = texts.join(phrases.hint("shuffle_hash"), "block", "left")
    messages = map_batches(
        known, send_entries, "block long, shard int, keys binary, shapes binary, blob binary"
    )
    windows = ask_shards(messages, compare_entries, "windows")

    fields = T.StructType.fromDDL(DIGESTS if digests else TEXTS)
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField(out, fields)])
    text_at = needed.index(text)
    kept_at = [needed.index(c) for c in keep]

    def finish(batches: Rows) -> Rows:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                rows = block_rows(batch.column(1).slice(i, 1))
                own = column_bytes(rows.column(text_at))
                block = Block(own, hasher, length, shards)
                block.learn_phrases(batch.column(2)[i].as_py())
                removed = block.removed(batch.column(3)[i].as_py())
                bounds = block.parse.offsets.tolist()
                n_removed, n_spans, spans, kept = [], [], [], []
                for a, b, value in zip(bounds, bounds[1:], own):
                    mask = removed[a:b]
                    runs = spans_of(mask)
                    n_removed.append(int(mask.sum()))
                    n_spans.append(len(runs))
                    if len(runs):
                        value = block.parse.data[a:b][~mask].tobytes()
                    kept.append(hashlib.sha256(value).hexdigest() if digests else value)
                    spans.append([{"start": x, "end": y} for x, y in runs.tolist()])
                sizes = [len(x) for x in own]
                result = [
                    ("n_bytes", pa.array(sizes, pa.int64())),
                    ("n_removed", pa.array(n_removed, pa.int64())),
                    ("n_spans", pa.array(n_spans, pa.int64())),
                ]
                if digests:
                    result.append(("kept_sha256", pa.array(kept, pa.string())))
                else:
                    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                    result.append(("spans", pa.array(spans, pa.list_(span))))
                    result.append(("kept", pa.array(kept, pa.binary())))
                columns = [rows.column(k) for k in kept_at]
                yield pa.RecordBatch.from_arrays([*columns, struct_of(result)], [*keep, out])

    answered = blocks.join(phrases.hint("shuffle_hash"), "block", "left").join(
        windows.hint("shuffle_hash"), "block", "left"
    )
    answered = answered.select("block", "docs", "phrases", "windows")
    return map_batches(answered, finish, schema)

"""Language-model scores from a bigram trie in Elias-Fano form.

The model is the smoothed bigram ``(c(v, w) + m p(w)) / (c(v) + m)``, where ``p`` is the
unigram with one added, and ``v`` the word before or the beginning of the text; the end
of a text is a word. What is seen in learning is in the trie: a level of contexts and
a level of the words that follow each, numbered by the vocabulary of the shard. These
are monotone sequences in Elias-Fano form, as are the pointers between them; the word
level is made monotone by counting on from context to context. The pointers of a context
tell which part of the level holds its words; a word is found by successor search in that
part, relative to its context.
Probabilities are kept as one byte, in steps of 1/16 of a power of ten. The levels lie
one behind another in one memory map.

The trie is split into shards by context; a context with very many occurrences is split
by the next word as well. Blocks of texts stay where they are stored: they send their
words and get counts, then send their pairs of words and get probabilities. A pair goes
once per block, so what moves grows with the different pairs of the blocks.

Words are known by 64-bit hashes, following words within a context by 32 bits of
them. Null and empty texts are one token, the end. Without any text to learn from,
counts are 0 and scores are finite. Repeated rows are scored alike and each learnt
from. An empty table gives an empty result.
"""

from __future__ import annotations

import mmap
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwall.llm.common import (
    Rows, ask_shards, block_rows, column_bytes, free_name, map_batches, pack_blocks, replies,
    struct_of,
)
from emberwall.llm.words import Hasher, chunks, mix

FIELDS = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
BEGIN, END = np.uint64(0x1B873593CC9E2D51), np.uint64(0xE6546B6485EBCA6B)
STEPS = 16  # of a stored probability, per power of ten
UNSEEN = 255
LOWER_STEPS = 4096  # of a unigram probability sent along
SAMPLE = 4096  # elements between entries of a directory


# --- Elias-Fano sequences ---------------------------------------------------------


def encode_monotone(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """A monotone sequence of numbers below ``universe``: the low bits of each, in
    whole bytes, and the high bits in unary; and for every ``SAMPLE``-th element
    its value and the place of its bit."""
    n = max(len(values), 1)
    low_bits = 8 * -(-max(universe // n - 1, 0).bit_length() // 8)
    low_bits = min(low_bits, 64)
    width = low_bits // 8
    values = values.astype(np.uint64)
    low = values.view(np.uint8).reshape(-1, 8)[:, :width]
    high = values >> np.uint64(low_bits) if low_bits < 64 else np.zeros(len(values), np.uint64)
    place = high.astype(np.int64) + np.arange(len(values))
    size = int(place[-1]) + 1 if len(place) else 0
    bits = np.zeros(size, np.uint8)
    bits[place] = 1
    return {
        "low": np.ascontiguousarray(low).ravel(),
        "high": np.packbits(bits, bitorder="little"),
        "first": values[::SAMPLE],
        "place": place[::SAMPLE],
        "shape": np.array([len(values), width], np.int64),
    }


def decode_part(level: dict[str, np.ndarray], sample: int) -> np.ndarray:
    """The elements from one entry of the directory up to the next."""
    n, width = level["shape"].tolist()
    start = sample * SAMPLE
    count = min(SAMPLE, n - start)
    place = level["place"]
    begin = int(place[sample])
    end = int(place[sample + 1]) if sample + 1 < len(place) else len(level["high"]) * 8
    raw = np.unpackbits(level["high"][begin // 8 : -(-end // 8)], bitorder="little")
    ones = np.flatnonzero(raw[begin % 8 :])[:count] + begin
    high = (ones - np.arange(start, start + count)).astype(np.uint64)
    low = np.zeros((count, 8), np.uint8)
    low[:, :width] = level["low"][start * width : (start + count) * width].reshape(count, width)
    low = low.view(np.uint64).ravel()
    return low if width == 8 else (high << np.uint64(8 * width)) | low


def successor(
    level: dict[str, np.ndarray],
    targets: np.ndarray,
    begin: np.ndarray | None = None,
    end: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """For targets in order: the number of the first element not below each, and
    whether it equals the target; with ``begin`` and ``end``, of the elements from the one
    up to the other, for each target. Only parts that hold a target are decoded."""
    first = level["first"]
    n = int(level["shape"][0])
    at = np.full(len(targets), n, np.int64) if end is None else end.astype(np.int64)
    equal = np.zeros(len(targets), bool)
    if not n or not len(targets):
        return at, equal
    # a target equal to the first element of a part may begin in the part before
    part = np.maximum(np.searchsorted(first, targets, "right") - 1, 0)
    asked = np.arange(len(targets))
    if begin is not None:
        part = np.clip(part, begin // SAMPLE, np.maximum(end - 1, begin) // SAMPLE)
        asked = np.flatnonzero(begin < end)
    edges = np.flatnonzero(np.diff(part[asked], prepend=-1, append=-1))
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        own = asked[a:b]
        start = int(part[own[0]]) * SAMPLE
        values = decode_part(level, int(part[own[0]]))
        found = np.searchsorted(values, targets[own])
        last = len(values)
        if begin is not None:
            found = np.maximum(found, begin[own] - start)
            last = np.minimum(last, end[own] - start)
        at[own] = found + start
        inside = found < last
        held = own[inside]
        equal[held] = values[found[inside]] == targets[held]
    return at, equal


def access(level: dict[str, np.ndarray], places: np.ndarray) -> np.ndarray:
    """The elements at places in order."""
    out = np.zeros(len(places), np.int64)
    part = places // SAMPLE
    edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1))
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        values = decode_part(level, int(part[a]))
        out[a:b] = values[places[a:b] - part[a] * SAMPLE]
    return out


class Trie:
    """Contexts, pointers, following words and their codes, in one memory map."""

    def __init__(self, context: np.ndarray, start: np.ndarray, word: np.ndarray, code: np.ndarray):
        """``context`` in order; ``start`` is where its words begin, one more than
        contexts; ``word`` in order within a context."""
        vocabulary, number = np.unique(word, return_inverse=True)
        self.different = max(len(vocabulary), 1)
        relative = np.repeat(np.arange(len(context), dtype=np.uint64), np.diff(start))
        chained = relative * np.uint64(self.different) + number.astype(np.uint64)
        levels = {
            "contexts": encode_monotone(context, 1 << 64),
            "vocabulary": encode_monotone(vocabulary, 1 << 32),
            "pointers": encode_monotone(start.astype(np.uint64), len(word) + 1),
            "words": encode_monotone(chained, max(len(context), 1) * self.different),
        }
        arrays = {(k, name): x for k, level in levels.items() for name, x in level.items()}
        arrays["codes", ""] = code.astype(np.uint8)
        self.bytes = sum(-(-x.nbytes // 8) * 8 for x in arrays.values())
        self.map = mmap.mmap(-1, max(self.bytes, 8))
        views, at = {}, 0
        for key, x in arrays.items():
            view = np.frombuffer(self.map, x.dtype, len(x), at)
            view[:] = x
            views[key] = view
            at += -(-x.nbytes // 8) * 8
        self.levels = {
            k: {name: views[k, name] for name in level} for k, level in levels.items()
        }
        self.codes = views["codes", ""]

    def find(self, context: np.ndarray, of: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Codes of pairs in order, or ``UNSEEN``: ``context`` are the different contexts
        asked for, in order, ``of`` which one of them each pair has."""
        number, known = successor(self.levels["contexts"], context)
        asked_words, place = np.unique(word, return_inverse=True)
        own, in_trie = successor(self.levels["vocabulary"], asked_words.astype(np.uint64))
        out = np.full(len(word), UNSEEN, np.uint8)
        asked = np.flatnonzero(known[of] & in_trie[place])
        # where the words of each known context begin and end
        begin, end = np.zeros((2, len(context)), np.int64)
        begin[known] = access(self.levels["pointers"], number[known])
        end[known] = access(self.levels["pointers"], number[known] + 1)
        base = number[of[asked]].astype(np.uint64) * np.uint64(self.different)
        at, equal = successor(
            self.levels["words"],
            base + own[place[asked]].astype(np.uint64),
            begin[of[asked]],
            end[of[asked]],
        )
        out[asked[equal]] = self.codes[at[equal]]
        return out


# --- shards -------------------------------------------------------------------


def group_sums(keys: np.ndarray, values: np.ndarray):
    """Different keys in order, the sum of their values, and which one each is."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    number = np.cumsum(first) - 1
    at = np.empty(len(keys), np.int64)
    at[order] = number
    sums = np.zeros(int(number[-1]) + 1 if len(number) else 0, np.int64)
    np.add.at(sums, number, values[order])
    return ranked[first], sums, at


def count_words(table: pa.Table) -> pa.Table:
    """Counts over all messages, for each message; block -1 gets the sum of the
    counts and how many words have one."""
    words = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
    counts = [np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()]
    _, sums, at = group_sums(np.concatenate(words), np.concatenate(counts))
    total = sums[at]
    ends = np.cumsum([len(x) for x in words]).tolist()
    parts = [total[e - len(x) : e] for e, x in zip(ends, words)]
    kind = "<u4" if not len(sums) or sums.max() < 1 << 32 else "<u8"
    answer = replies(table, [x.astype(kind).tobytes() for x in parts])
    stats = np.array([sums.sum(), (sums > 0).sum()], "<i8").tobytes()
    extra = pa.Table.from_arrays(
        [pa.array([-1], pa.int64()), table.column("shard").slice(0, 1).combine_chunks(),
         pa.array([stats], pa.binary())],
        ["block", "shard", "reply"],
    )
    return pa.concat_tables([answer.cast(extra.schema), extra])


def pair_codes(table: pa.Table, strength: float) -> pa.Table:
    """Build the trie of a shard from all messages and answer them from it."""
    contexts = [np.frombuffer(x, np.uint64) for x in table.column("contexts").to_pylist()]
    children = [np.frombuffer(x, np.uint32) for x in table.column("children").to_pylist()]
    totals = [np.frombuffer(x, np.int64) for x in table.column("totals").to_pylist()]
    words = [np.frombuffer(x, np.uint32) for x in table.column("words").to_pylist()]
    lower = [np.frombuffer(x, np.uint16) for x in table.column("lower").to_pylist()]
    raw = [np.frombuffer(x, np.uint8) for x in table.column("counts").to_pylist()]
    big = [np.frombuffer(x, np.int64) for x in table.column("big").to_pylist()]
    count = np.concatenate(raw).astype(np.int64)
    count[count == 255] = np.concatenate(big)
    n_children = np.concatenate(children)
    all_contexts, all_totals = np.concatenate(contexts), np.concatenate(totals)

    # pairs by context and word
    known, _, of_message = group_sums(all_contexts, all_totals)
    total = np.zeros(len(known), np.int64)
    total[of_message] = all_totals  # -1 where the shard has the whole context
    of = np.repeat(of_message, n_children)
    key = (of.astype(np.uint64) << np.uint64(32)) | np.concatenate(words).astype(np.uint64)
    pairs, sums, at = group_sums(key, count)
    p = np.zeros(len(pairs), np.uint16)
    p[at] = np.concatenate(lower)
    context_of = (pairs >> np.uint64(32)).astype(np.int64)
    word = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)

    own = np.bincount(context_of, weights=sums, minlength=len(known)).astype(np.int64)
    total = np.where(total < 0, own, total)
    seen = sums > 0
    chance = (sums[seen] + strength * 10.0 ** (-p[seen].astype(float) / LOWER_STEPS)) / (
        total[context_of[seen]] + strength
    )
    code = np.clip(np.rint(-np.log10(chance) * STEPS), 0, UNSEEN - 1)
    used, place = np.unique(context_of[seen], return_index=True)
    trie = Trie(known[used], np.append(place, int(seen.sum())), word[seen], code)

    found = trie.find(known, context_of, word)[at]
    ends = np.cumsum([len(x) for x in words]).tolist()
    return replies(table, [found[e - len(x) : e].tobytes() for e, x in zip(ends, words)])


# --- blocks -------------------------------------------------------------------


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


@dataclass
class Totals:
    tokens: int  # N
    words: int  # V
    texts: int  # ends

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return (count + 1) / (self.tokens + 1 * (self.words + 1))


class Block:
    """The tokens of a block, the messages it sends and the scores it makes."""

    def __init__(self, texts: list[bytes], learn: np.ndarray, hasher: Hasher, shards: int):
        parts, sizes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for part in chunks(texts, hasher, lower=True):
            parts.append(part.word_hashes())
            sizes.append(np.diff(part.word_offsets))
        words, self.n_words = np.concatenate(parts), np.concatenate(sizes)
        n = len(texts)
        self.shards, self.n_texts = shards, n
        self.owner = np.repeat(np.arange(n), self.n_words + 1)
        ends = np.cumsum(self.n_words + 1) - 1
        tokens = np.full(len(self.owner), END, np.uint64)
        inner = np.ones(len(tokens), bool)
        inner[ends] = False
        tokens[inner] = words
        before = np.concatenate(([BEGIN], tokens[:-1]))[: len(tokens)]
        before[ends[:-1] + 1] = BEGIN
        self.learn = learn[self.owner]

        # every word of the block and the beginning, in order; numbers of the tokens
        self.words, numbers = np.unique(np.append(tokens, BEGIN)), None
        numbers = np.searchsorted(self.words, tokens)
        self.begin = int(np.searchsorted(self.words, BEGIN))
        self.end = int(np.searchsorted(self.words, END)) if n else -1
        self.token = numbers
        self.before = np.where(before == BEGIN, self.begin, np.roll(numbers, 1))
        self.own = np.bincount(numbers[self.learn], minlength=len(self.words))
        self.word_bounds = np.searchsorted(
            shard_of(self.words, shards), np.arange(shards + 1)
        )

    def word_message(self):
        for s in np.flatnonzero(np.diff(self.word_bounds)).tolist():
            part = slice(self.word_bounds[s], self.word_bounds[s + 1])
            yield s, self.words[part].tobytes(), self.own[part].astype("<i8").tobytes()

    def learn_words(self, answer: list[dict], totals: Totals) -> None:
        held = {x["shard"]: x["reply"] for x in answer}
        self.count = np.zeros(len(self.words), np.int64)
        for s in np.flatnonzero(np.diff(self.word_bounds)).tolist():
            part = slice(self.word_bounds[s], self.word_bounds[s + 1])
            n = part.stop - part.start
            self.count[part] = np.frombuffer(held[s], "<u4" if len(held[s]) == 4 * n else "<u8")
        self.totals = totals
        self.p = totals.unigram(self.count)
        self.context = self.count.copy()  # how often a word is a context
        self.context[self.begin] = totals.texts
        if self.end >= 0:
            self.context[self.end] = 0

        # different pairs that can have been seen, by shard, context and word
        pair = (self.before.astype(np.int64) << 32) | self.token
        values, counts, at = group_sums(pair, self.learn.astype(np.int64))
        first, second = values >> 32, values & 0xFFFFFFFF
        sent = np.flatnonzero((self.context[first] > 0) & (self.count[second] > 0))
        f, s = self.words[first[sent]], self.words[second[sent]]
        hot = self.context[first[sent]] > max(totals.tokens // (4 * self.shards), 1)
        route = shard_of(np.where(hot, mix(f + mix(s)), f), self.shards)
        order = np.argsort(route, kind="stable")
        self.sent, self.pair_of = sent[order], at
        self.first, self.second, self.pair_counts = first, second, counts
        self.hot = hot[order]
        self.pair_bounds = np.searchsorted(route[order], np.arange(self.shards + 1))

    def pair_message(self):
        for s in np.flatnonzero(np.diff(self.pair_bounds)).tolist():
            part = slice(self.pair_bounds[s], self.pair_bounds[s + 1])
            at = self.sent[part]
            first = self.first[at]
            new = np.flatnonzero(np.diff(first, prepend=-1))
            n = np.diff(np.append(new, len(first)))
            total = np.where(self.hot[part][new], self.context[first[new]], -1)
            second = self.second[at]
            count = self.pair_counts[at]
            lower = np.rint(-np.log10(self.p[second]) * LOWER_STEPS)
            yield (
                s,
                self.words[first[new]].tobytes(),
                n.astype("<u4").tobytes(),
                total.astype("<i8").tobytes(),
                (self.words[second] >> np.uint64(32)).astype("<u4").tobytes(),
                np.minimum(lower, 65535).astype("<u2").tobytes(),
                np.minimum(count, 255).astype("<u1").tobytes(),
                count[count >= 255].astype("<i8").tobytes(),
            )

    def scores(self, answer: list[dict] | None, strength: float):
        """Per text: tokens, known tokens, base score, score."""
        held = {x["shard"]: x["reply"] for x in answer or []}
        code = np.full(len(self.first), UNSEEN, np.uint8)
        for s in np.flatnonzero(np.diff(self.pair_bounds)).tolist():
            part = slice(self.pair_bounds[s], self.pair_bounds[s + 1])
            code[self.sent[part]] = np.frombuffer(held[s], np.uint8)
        lower = np.log10(self.p)
        back = np.log10(strength / (self.context + strength))
        pair = np.where(
            code == UNSEEN, back[self.first] + lower[self.second], -code.astype(float) / STEPS
        )
        n = self.n_texts
        known = np.bincount(self.owner, weights=self.count[self.token] > 0, minlength=n)
        base = np.bincount(self.owner, weights=lower[self.token], minlength=n)
        score = np.bincount(self.owner, weights=pair[self.pair_of], minlength=n)
        return self.n_words + 1, known.astype(np.int64), base, score


# --- the operator ---------------------------------------------------------------


def score_texts(
    docs: DataFrame,
    learn_from: Column,
    text: str = "text",
    out: str = "lm",
    keep: Sequence[str] | None = None,
    strength: float = 64.0,
    block_bytes: int = 1 << 22,
) -> DataFrame:
    """``docs`` (of its columns those in ``keep``, by default all) with a struct column
    ``out``: ``n_tokens``, ``n_known`` (seen in learning), ``train_tokens``,
    ``base_score`` (the unigram) and ``score``, both as log10 of the text's probability.

    ``learn_from`` says, on a row, whether its text is learnt from; ``strength`` is
    ``m``, the weight of the unigram. ``block_bytes`` of text are worked on at a time,
    in about 60 times as much memory.
    """
    spark = docs.sparkSession
    keep = list(docs.columns) if keep is None else list(keep)
    learn = free_name(docs, "learn")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c in keep or c == text],
        F.coalesce(learn_from, F.lit(False)).alias(learn),
    )
    kept = rows.columns
    blocks, shards = pack_blocks(rows, text, block_bytes)
    texts = blocks.select(
        "block", F.col(f"docs.`{text}`").alias("texts"), F.col(f"docs.`{learn}`").alias("learn")
    )

    def built(texts: pa.Array, learn: pa.Array, hasher: Hasher) -> Block:
        mask = np.array(learn.flatten().to_pylist(), bool)
        return Block(column_bytes(texts.flatten()), mask, hasher, shards)

    def send_words(batches: Rows) -> Rows:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                block = built(batch.column(1).slice(i, 1), batch.column(2).slice(i, 1), hasher)
                shard, words, counts = zip(*block.word_message())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * len(shard), pa.int64()),
                     pa.array(shard, pa.int32()), pa.array(words, pa.binary()),
                     pa.array(counts, pa.binary())],
                    ["block", "shard", "words", "counts"],
                )

    messages = map_batches(
        texts, send_words, "block long, shard int, words binary, counts binary"
    )
    words = ask_shards(messages, count_words, "words")

    # one pair of numbers per shard comes to the driver, and the count of the end
    stats = words.filter("block = -1").select(F.explode("words.reply")).collect()
    tokens, different = np.sum(
        [np.frombuffer(x[0], "<i8") for x in stats] or [np.zeros(2, np.int64)], axis=0
    ).tolist()
    learnt = rows.filter(F.col(f"`{learn}`")).count()
    totals = (tokens, different, learnt)

    names = ["contexts", "children", "totals", "words", "lower", "counts", "big"]

    def send_pairs(batches: Rows) -> Rows:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                block = built(batch.column(1).slice(i, 1), batch.column(2).slice(i, 1), hasher)
                block.learn_words(batch.column(3)[i].as_py(), Totals(*totals))
                sent = list(block.pair_message())
                if sent:
                    shard, *parts = zip(*sent)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[i].as_py()] * len(shard), pa.int64()),
                         pa.array(shard, pa.int32()),
                         *[pa.array(x, pa.binary()) for x in parts]],
                        ["block", "shard", *names],
                    )

    def answer_pairs(table: pa.Table) -> pa.Table:
        return pair_codes(table, strength)

    known = texts.join(words.hint("shuffle_hash"), "block", "left")
    kinds = ", ".join(f"{name} binary" for name in names)
    messages = map_batches(
        known.select("block", "texts", "learn", "words"),
        send_pairs,
        f"block long, shard int, {kinds}"
    )
    pairs = ask_shards(messages, answer_pairs, "pairs")

    schema = T.StructType(
        [*[rows.schema[c] for c in keep], T.StructField(out, T.StructType.fromDDL(FIELDS))]
    )
    text_at, learn_at = kept.index(text), kept.index(learn)
    kept_at = [kept.index(c) for c in keep]

    def finish(batches: Rows) -> Rows:
        hasher = Hasher()
        for batch in batches:
            for i in range(batch.num_rows):
                own = block_rows(batch.column(1).slice(i, 1))
                mask = np.array(own.column(learn_at).to_pylist(), bool)
                block = Block(column_bytes(own.column(text_at)), mask, hasher, shards)
                block.learn_words(batch.column(2)[i].as_py(), Totals(*totals))
                n, seen, base, score = block.scores(batch.column(3)[i].as_py(), strength)
                result = [
                    ("n_tokens", pa.array(n, pa.int64())),
                    ("n_known", pa.array(seen)),
                    ("train_tokens", pa.array([tokens] * len(n), pa.int64())),
                    ("base_score", pa.array(base)),
                    ("score", pa.array(score)),
                ]
                columns = [own.column(k) for k in kept_at]
                yield pa.RecordBatch.from_arrays([*columns, struct_of(result)], [*keep, out])

    answered = blocks.join(words.hint("shuffle_hash"), "block", "left").join(
        pairs.hint("shuffle_hash"), "block", "left"
    )
    return map_batches(answered.select("block", "docs", "words", "pairs"), finish, schema)

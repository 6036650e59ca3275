"""Operators that need the whole corpus, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emberwall.llm import common, neighbour_vote, ngram_trie, simhash_index
from emberwall.llm.common import pack_blocks
from emberwall.llm.components import components, forest
from emberwall.llm.kmeans_tree import search
from emberwall.llm.neighbour_vote import score_quality, term_counts
from emberwall.llm.ngram_trie import Trie, encode_monotone, score_texts, successor
from emberwall.llm.pattern_packing import (
    Encoder,
    Generations,
    fit_nonnegative,
    groups_of,
    make_plan,
    pack,
    patterns,
)
from emberwall.llm.prefix_free import Block, count_phrases, remove_repeats, suffix_ranks
from emberwall.llm.simhash_index import fingerprint, free_positions, near_duplicates
from emberwall.llm.words import Hasher


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# --- language model -----------------------------------------------------------------


def test_scores_as_the_plain_model(docs, texts, by_text):
    strength = 64.0
    found = by_text(
        score_texts(docs, F.col("doc_id") % 5 != 2, out="lm", block_bytes=20_000), "lm"
    )
    assert set(found) == set(texts)
    count, pair, learnt = Counter(), Counter(), 0
    for i, text in texts:
        if i is not None and i % 5 != 2:
            tokens = [*words_of(lower(text)), "</s>"]
            count.update(tokens)
            pair.update(zip(["<s>", *tokens], tokens))
            learnt += 1
    total, different = sum(count.values()), len(count)
    for (_, text), got in found.items():
        tokens = [*words_of(lower(text)), "</s>"]
        base = score = 0.0
        for v, w in zip(["<s>", *tokens], tokens):
            p = (count[w] + 1) / (total + different + 1)
            context = learnt if v == "<s>" else count[v]
            base += math.log10(p)
            chance = (pair[v, w] + strength * p) / (context + strength)
            score += round(-math.log10(chance) * 16) / -16 if pair[v, w] else math.log10(chance)
        assert got["n_tokens"] == len(tokens)
        assert got["n_known"] == sum(count[w] > 0 for w in tokens)
        assert got["train_tokens"] == total
        assert got["base_score"] == pytest.approx(base, rel=1e-12)
        # a probability on the edge between two steps may fall to either side
        assert got["score"] == pytest.approx(score, abs=0.07 * (1 + len(tokens) / 500))


def test_nothing_to_learn_from(docs, by_text):
    for got in by_text(score_texts(docs, F.lit(False), out="lm"), "lm").values():
        assert got["train_tokens"] == got["n_known"] == 0
        assert math.isfinite(got["score"]) and math.isfinite(got["base_score"])


def test_frequent_contexts_are_split(spark, by_text):
    rows = [(i, "the " + " the ".join(f"w{k}" for k in range(i, i + 300))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learn = F.lit(True)
    found = by_text(score_texts(df, learn, out="lm", block_bytes=9000), "lm")
    one = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        whole = by_text(score_texts(df, learn, out="lm"), "lm")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", one)
    assert found == whole


@pytest.mark.parametrize("universe", [1 << 64, 1 << 40, 100_000])
def test_successor(universe):
    rng = np.random.default_rng(1)
    top = min(universe, (1 << 63) - 1)
    values = np.sort(rng.integers(0, top, 20_000)).astype(np.uint64)
    level = encode_monotone(values, universe)
    targets = np.sort(np.concatenate([values[::7], rng.integers(0, top, 5000).astype(np.uint64)]))
    at, equal = successor(level, targets)
    expect = np.searchsorted(values, targets)
    known = np.isin(targets, values)
    assert (equal == known).all()
    assert (values[at[known]] == targets[known]).all()
    rest = ~known
    assert (at[rest] == expect[rest]).all()


def test_trie_is_compact_and_finds_what_is_in_it():
    rng = np.random.default_rng(3)
    context = np.unique(rng.integers(0, 1 << 63, 3000)).astype(np.uint64)
    n = rng.integers(1, 40, len(context))
    start = np.concatenate(([0], np.cumsum(n)))
    pool = rng.choice(1 << 31, 4000, False)
    word = np.concatenate([np.sort(rng.choice(pool, k, False)) for k in n]).astype(np.uint32)
    code = rng.integers(0, 255, len(word))
    trie = Trie(context, start, word, code)
    of = np.repeat(np.arange(len(context)), n)
    assert (trie.find(context, of, word) == code).all()
    assert (trie.find(context, of, word ^ np.uint32(1 << 31)) == ngram_trie.UNSEEN).all()
    assert trie.bytes < 0.7 * (word.nbytes + context.nbytes + start.nbytes + len(word))


def test_pointers_bound_the_search():
    """Words are looked for where the pointers say, and nowhere else."""
    rng = np.random.default_rng(5)
    context = np.unique(rng.integers(0, 1 << 63, 2000)).astype(np.uint64)
    n = rng.integers(1, 60, len(context))
    start = np.concatenate(([0], np.cumsum(n)))
    word = np.concatenate([np.sort(rng.choice(5000, k, False)) for k in n]).astype(np.uint32)
    code = rng.integers(0, 255, len(word))
    of = np.repeat(np.arange(len(context)), n)
    trie = Trie(context, start, word, code)
    assert (ngram_trie.access(trie.levels["pointers"], np.arange(len(start))) == start).all()
    assert (trie.find(context, of, word) == code).all()
    # the last word of each context left out by its pointers isn't found any more
    for cut, lost in ((np.append(start[:-1], start[-1] - 1), [len(word) - 1]), (start * 0, of >= 0)):
        trie.levels["pointers"] = encode_monotone(cut.astype(np.uint64), len(word) + 1)
        found = trie.find(context, of, word)
        assert (found[lost] == ngram_trie.UNSEEN).all()
        rest = np.ones(len(word), bool)
        rest[lost] = False
        assert (found[rest] == code[rest]).all()


def test_shards_follow_the_stored_bytes(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.random()}" for _ in range(400))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = [pack_blocks(part, "text", 20_000, 16 << 10)[1] for part in (df, df.union(df))]
    assert parts < found[0] and 1.6 < found[1] / found[0] < 2.4
    assert pack_blocks(df, "text", 20_000)[1] == parts
    whole = score_texts(df, F.lit(True), out="lm", block_bytes=20_000).collect()
    before, common.SHARD_BYTES = common.SHARD_BYTES, 16 << 10
    common.pack_blocks.__defaults__ = (16 << 10,)
    try:
        more = score_texts(df, F.lit(True), out="lm", block_bytes=20_000).collect()
    finally:
        common.SHARD_BYTES = before
        common.pack_blocks.__defaults__ = (before,)
    assert {r.doc_id: r.lm for r in whole} == {r.doc_id: r.lm for r in more}


# --- quality classifier ---------------------------------------------------------------


def test_votes_are_learnt_without_held_out_labels(spark, docs, texts, by_text):
    bad = {37, 38, 39}
    rows = [(i, int(i not in bad)) for i, _ in texts if i is not None and i < 42]
    rows += [(i, 0) for i in range(0, 42, 3)]  # these must not be learnt from
    rows += [(None, 1), (5, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    learn = F.col("doc_id") % 3 != 0
    found = by_text(score_quality(docs, labels, learn, out="vote", k=3), "vote")
    assert set(found) == set(texts)
    assert all(0 <= v["score"] <= 1 for v in found.values())
    good = {i: v["score"] for (i, _), v in found.items() if i is not None and i < 30}
    assert min(good.values()) >= 0.5
    assert all(v["score"] < 0.5 for (i, _), v in found.items() if i in bad - {39})


def test_terms_do_not_depend_on_the_texts_before():
    text = b"a b c d a b c e"
    for before in (b"x", b"x y z w v", b""):
        counts = np.concatenate([c for _, c in term_counts([text, before, text], Hasher())])
        assert (counts[0] == counts[2]).all()


def test_no_labels(spark, docs, no_docs, by_text):
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = by_text(score_quality(docs, none, F.lit(True), out="vote"), "vote")
    assert {v["score"] for v in found.values()} == {0.5}
    assert score_quality(no_docs, none, F.lit(True), out="vote").count() == 0


def plain_terms(text):
    """Counts per term, one byte and one word after the other."""
    raw = (text or "").encode()
    counts = np.zeros(neighbour_vote.TERMS)
    for a, b in zip(raw, raw[1:]):
        counts[neighbour_vote._PAIR[a * 256 + b]] += 1
    hasher, words = Hasher(), re.findall(rb"[^\x20\x09-\x0D]+", raw)
    for word in words:
        sums = hasher.sums(np.frombuffer(word, np.uint8))
        hashed = int(hasher.spans(sums, np.array([0]), np.array([len(word)]))[0])
        counts[neighbour_vote.PAIR_TERMS + hashed % neighbour_vote.WORD_TERMS] += 1
    runs = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i, run in enumerate(zip(words, words[1:], words[2:])) if runs[run] > 1 for k in range(3)}
    for place in marked:
        at = neighbour_vote.PAIR_TERMS + neighbour_vote.WORD_TERMS + place % neighbour_vote.REPEAT_TERMS
        counts[at] += 1
    return counts


@pytest.mark.parametrize("k", [1, 4, 100])
def test_votes_as_by_all_cosines(spark, k):
    """Fewer labelled rows than dimensions: their whole space is kept, so the vectors are
    known without any random block, and each cosine can be compared one by one."""
    rng = random.Random(31)
    pool = [f"w{n}{'aeiou'[n % 5]}n" for n in range(300)]
    texts = {}
    for i in range(70):
        words = [rng.choice(pool[:200] if i % 3 else pool[100:]) for _ in range(rng.randint(15, 90))]
        texts[i] = " ".join(words + words[:7] * (i % 4))
    texts |= {70: "", 71: None, 72: "é 日本", 73: texts[4]}
    label = {i: int(i % 3 == 0) for i in range(0, 50)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([*label.items(), (None, 1), (500, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.vote for r in score_quality(df, labels, F.col("doc_id") % 5 != 1, k=k).collect()}

    counts = {i: plain_terms(t) for i, t in texts.items()}
    seen = sum((c > 0).astype(int) for c in counts.values())
    rarity = np.log((1 + len(texts)) / (1 + seen)) + 1
    weighed = {i: np.log1p(c) * rarity for i, c in counts.items()}
    weighed = {i: w / max(np.linalg.norm(w), 1e-12) for i, w in weighed.items()}
    learnt = [i for i in label if i % 5 != 1]
    space, _ = np.linalg.qr(np.array([weighed[i] for i in learnt]).T)
    vectors = {i: w @ space for i, w in weighed.items()}
    for i, v in vectors.items():
        cosines = []
        for j in learnt:
            lengths = np.linalg.norm(v) * np.linalg.norm(vectors[j])
            cosines.append((float(v @ vectors[j]) / lengths if lengths > 1e-9 else 0.0, label[j]))
        near = sorted(cosines, reverse=True)[:k]
        weights = [max(c, 0.0) ** 4 for c, _ in near]
        share = sum(label[j] for j in learnt) / len(learnt)
        score = sum(w * y for w, (_, y) in zip(weights, near)) / sum(weights) if sum(weights) else share
        assert got[i].score == pytest.approx(score, abs=2e-3), i
        assert got[i].neighbours == min(k, len(learnt))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    scored = score_quality(documents, labels, ~held, out="vote", keep=["doc_id"])
    right = (F.col("vote.score") >= 0.5).cast("int") == F.col("quality")
    share = scored.filter(held).join(labels, "doc_id").agg(F.avg(right.cast("double"))).first()[0]
    assert share > 0.98


# --- repeated passages ------------------------------------------------------------------


def plain_repeats(texts, length):
    raw = [(t or "").encode() for _, t in texts]
    count = Counter(x[i : i + length] for x in raw for i in range(len(x) - length + 1))
    out = {}
    for (key, text), x in zip(texts, raw):
        covered = np.zeros(len(x), bool)
        for i in range(len(x) - length + 1):
            if count[x[i : i + length]] > 1:
                covered[i : i + length] = True
        out[key, text] = covered
    return out


@pytest.mark.parametrize("length", [200, 40])
def test_repeats_as_counted(docs, texts, by_text, length):
    expected = plain_repeats(texts, length)
    cut = remove_repeats(docs, out="repeats", length=length, block_bytes=15_000)
    digest = remove_repeats(docs, out="repeats", length=length, digests=True)
    digests = by_text(digest, "repeats")
    found = by_text(cut, "repeats")
    assert set(found) == set(digests) == set(texts)
    for key, covered in expected.items():
        raw = (key[1] or "").encode()
        left = np.frombuffer(raw, np.uint8)[~covered].tobytes()
        edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(int), [0]))))
        spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
        got = found[key]
        assert (got["n_bytes"], got["n_removed"]) == (len(raw), int(covered.sum()))
        assert got["spans"] == spans and got["n_spans"] == len(spans)
        assert bytes(got["kept"]) == left
        assert digests[key]["kept_sha256"] == hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghijklmnop"])
def test_repeats_in_plain_alphabets(spark, by_text, alphabet):
    import random

    rng = random.Random(len(alphabet))
    pieces = ["".join(rng.choice(alphabet) for _ in range(300)) for _ in range(3)]
    rows = []
    for i in range(20):
        parts = [rng.choice(pieces)[rng.randrange(200) :] for _ in range(3)]
        rows.append((i, "".join(p + "".join(rng.choice(alphabet) for _ in range(9)) for p in parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_text(remove_repeats(df, out="r", length=50, block_bytes=2000), "r")
    expected = plain_repeats(rows, 50)
    assert {k: v["n_removed"] for k, v in found.items()} == {
        k: int(v.sum()) for k, v in expected.items()
    }


def hot_texts():
    """A passage in many texts with different text around it."""
    rng = np.random.default_rng(12)

    def drawn(n):
        return "".join(chr(97 + x) for x in rng.integers(0, 26, n))

    passage = drawn(400)
    found = [(i, drawn(200) + passage + drawn(200)) for i in range(400)]
    return found + [(1000 + i, x[100:700]) for i, x in found[:20]]


def test_surroundings_of_hot_runs_are_spread():
    texts = [t.encode() for _, t in hot_texts()]
    hasher, shards = Hasher(), 8
    blocks = [Block(texts[i : i + 8], hasher, 200, shards) for i in range(0, len(texts), 8)]
    answers = {}
    for s in range(shards):
        sent = [(i, m) for i, b in enumerate(blocks) for m in b.phrase_message() if m[0] == s]
        table = pa.table({
            "block": pa.array([i for i, _ in sent], pa.int64()),
            "shard": pa.array([s] * len(sent), pa.int32()),
            "keys": pa.array([m[1] for _, m in sent], pa.binary()),
            "again": pa.array([m[2] for _, m in sent], pa.binary()),
        })
        for row in count_phrases(table).to_pylist():
            answers.setdefault(row["block"], []).append(row)
    per_run = Counter()
    for i, block in enumerate(blocks):
        block.learn_phrases(answers[i])
        per_run.update(block.entries.key.tolist())
    # before, some 400 surroundings of a run met in one shard
    assert max(per_run.values()) <= len(blocks)


def test_hot_runs_as_counted(spark, by_text):
    rows = hot_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = by_text(remove_repeats(df, out="r", block_bytes=5000), "r")
    expected = plain_repeats(rows, 200)
    for key, covered in expected.items():
        edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(int), [0]))))
        spans = [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]
        assert found[key]["spans"] == spans


def test_suffix_ranks_order_suffixes():
    words = [b"banana", b"ana", b"bandana", b"a"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.repeat(np.cumsum([len(w) for w in words]), [len(w) for w in words])
    suffixes = [w[i:] for w in words for i in range(len(w))]
    ranks = suffix_ranks(data, ends, 7)
    for a, x in zip(ranks, suffixes):
        for b, y in zip(ranks, suffixes):
            assert (a < b, a == b) == (x < y, x == y)


# --- SimHash -----------------------------------------------------------------------------


def plain_fingerprint(text):
    words = words_of(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_as_all_pairs(docs, texts):
    prints = [plain_fingerprint(t) for _, t in texts]
    group = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    members = {}
    for (i, _), g in zip(texts, group):
        members.setdefault(g, []).append(i)
    expected = {g: min((i for i in m if i is not None), default=None) for g, m in members.items()}
    want = Counter((i, f, expected[g]) for (i, _), f, g in zip(texts, prints, group))
    rows = near_duplicates(docs, out="simhash").collect()
    got = Counter(
        (r["doc_id"], r["simhash"]["fingerprint"] & (2**64 - 1), r["simhash"]["component_id"])
        for r in rows
    )
    assert got == want
    kept = [r["simhash"]["component_id"] for r in rows if r["simhash"]["keeps"]]
    assert Counter(kept) == Counter(expected.values())


@pytest.mark.parametrize("differing", [1, 2, 3])
def test_some_list_leaves_every_difference_free(differing):
    from itertools import combinations

    sets = free_positions(differing)
    for places in combinations(range(8), differing):
        assert any(set(places) <= set(free) for free in sets)


@pytest.mark.parametrize("short", [4, 300])
def test_long_and_short_lists_agree(spark, monkeypatch, short):
    monkeypatch.setattr(simhash_index, "SHORT_LIST", short)
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 1 << 63, 6).astype(np.uint64)
    values = list(centre)
    for _ in range(600):
        x = centre[rng.integers(6)]
        for _ in range(rng.integers(0, 5)):
            x ^= np.uint64(1) << np.uint64(rng.integers(64))
        values.append(x)
    values = np.unique(np.array(values, np.uint64))
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    a, b = np.nonzero(np.triu(near, 1))
    signed = values.view(np.int64)
    want = dict(zip(*[x.tolist() for x in forest(signed[a], signed[b])]))
    df = spark.createDataFrame([(int(x),) for x in signed], "v long")
    roots = components(simhash_index.near_links(df, "v", 2)).collect()
    assert {r["node"]: r["root"] for r in roots if r["node"] != r["root"]} == want


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 900), (900, 900)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 900, 900: 900}


def test_short_texts():
    for text in ("", "A", "a b", "a  b\nc", "x y z " * 40):
        assert fingerprint(text.encode()) == plain_fingerprint(text)


# --- packing -------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [64, 4096])
def test_packing(docs, texts, limit):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = pack(docs, path, keep=["doc_id", "text"], limit=limit).collect()
    pieces, places = {}, {}
    for r in rows:
        ids = np.array(r["ids"], "<u4")
        assert len(ids) == r["length"] <= limit
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
        assert r["start"] == r["piece"] * limit
        pieces.setdefault((r["doc_id"], r["text"]), []).append((r["piece"], list(r["ids"])))
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    copies = Counter(texts)
    for (key, text), own in pieces.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want = [(k, ids[i : i + limit]) for k, i in enumerate(range(0, len(ids), limit))]
        assert sorted(own) == sorted(want * copies[key, text])
    total = 0
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= limit
        total += end
    assert len(places) <= 1.03 * -(-total // limit) + 1


def test_frequent_words_stay_when_memory_is_full():
    memory = Generations(100)
    learnt = 0
    for round_ in range(50):
        memory.turn()
        unknown = memory.missing({f"new {round_} {k}" for k in range(20)} | {"hot", "warm"})
        learnt += len(unknown & {"hot", "warm"})
        memory.young.update(dict.fromkeys(unknown, b"ids"))
        assert len(memory.young) + len(memory.old) <= 2 * (100 + 22)
    assert learnt == 2 and not memory.missing({"hot"})


def test_words_as_the_library_splits_them():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    rng = np.random.default_rng(6)
    signs = list("abcXYZ'sStTreé.,!?0123²¼ªµŸÅßİıſ<|>\u0301日e\u0302-_ \t\n\x00\x1c\x85\u00a0")
    texts = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 60, 1500)]
    texts += ["<|endoftext|> a", "i'll don't 'Tis O'REILLY'S", "<|startoftext|>", "ǅ İİ ﬁ K"]
    for _ in range(2):  # learnt, then remembered
        for first in range(0, len(texts), 300):
            group = texts[first : first + 300]
            found = encoder.encode([t.encode() for t in group])
            for text, raw in zip(group, found):
                ids = library.encode(text, add_special_tokens=False).ids
                assert np.frombuffer(raw, "<u4").tolist() == ids, text


def test_different_words_are_looked_up_once_and_the_tokenizer_is_kept():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    encoder = Encoder(definition)
    assert Encoder(definition).tokenizer is encoder.tokenizer
    asked = []

    class Asked(dict):
        def get(self, key, default=None):
            asked.append(key)
            return dict.get(self, key, default)

    encoder.words.young = Asked(encoder.words.young)
    encoder.encode([b"one two one", b"two  one\x0btwo\x1c", b""] * 50)
    assert Counter(asked) == Counter([b"one", b"two", b"two\x1c", b""])
    memory = common.worker_memory(f"packing {zlib.crc32(definition.encode())}")
    memory["words"] = Generations(100)  # an ordinary dictionary for those after


def test_groups_of_texts_are_whole_and_bounded():
    texts = [b"x" * n for n in (3, 0, 4, 20, 1, 1, 9, 0)]
    groups = list(groups_of(texts, 10))
    assert [x for _, group in groups for x in group] == texts
    assert all(texts[first : first + len(group)] == group for first, group in groups)
    assert all(len(group) == 1 or sum(map(len, group)) <= 10 for _, group in groups)
    assert list(groups_of([], 10)) == [] and list(groups_of([b""], 10)) == [(0, [b""])]


def test_texts_without_words_and_bytes_that_are_no_text():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    assert encoder.encode([b"", b" \n\t ", b""]) == [b"", b"", b""]
    broken = [b"\xff\xfe a\x80b \xe6\x97", b" a\x00b ", b"", b"\x1fa \xc2\xa0 b"]
    for text, raw in zip(broken, encoder.encode(broken)):
        shown = text.decode("utf-8", "replace")
        ids = library.encode(shown, add_special_tokens=False).ids
        assert np.frombuffer(raw, "<u4").tolist() == ids, text


def test_results_keep_their_names(docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    packed = pack(docs, path)
    assert len(packed.columns) == len(set(packed.columns)) and "score" in packed.columns
    with pytest.raises(ValueError):
        pack(docs, path, keep=["length"])


def test_patterns_are_all_partitions():
    columns = patterns(12, 4)
    assert ((np.arange(1, 13) @ columns) == 12).all()
    assert columns.sum(axis=0).min() >= 2 and columns.sum(axis=0).max() <= 4
    # partitions of 12 into 2, 3 and 4 parts
    assert columns.shape[1] == 6 + 12 + 15
    assert len(np.unique(columns, axis=1).T) == columns.shape[1]


def test_fit_is_not_negative_and_optimal():
    rng = np.random.default_rng(1)
    a = rng.random((12, 40))
    b = a @ np.where(rng.random(40) < 0.2, rng.random(40) * 9, 0)
    x = fit_nonnegative(a, b)
    assert (x >= 0).all() and np.abs(a @ x - b).max() < 1e-6


@pytest.mark.parametrize("n", [0, 1, 7, 3000, 10**9])
def test_plan_places_every_piece_once(n):
    rng = np.random.default_rng(4)
    lengths = np.minimum(rng.lognormal(6, 1.2, 3000).astype(int) + 1, 4096)
    histogram = np.bincount(lengths[: min(n, 3000)], minlength=4097) * max(1, n // 3000)
    plan = make_plan(histogram)
    placed = np.zeros(4097, np.int64)
    for length, first, copies, _, offset in plan.runs:
        assert first == placed[length] and offset + length <= 4096
        placed[length] += copies
    assert (placed == histogram).all()
    least = -(-int((histogram * np.arange(4097)).sum()) // 4096)
    assert least <= plan.sequences <= 1.01 * least + 1
    assert len(plan.runs) < 60_000


# --- nearest neighbours ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    middles = rng.standard_normal((12, 16))
    rows = [
        (i, [float(x) for x in middles[rng.integers(12)] + 0.6 * rng.standard_normal(16)])
        for i in range(3000)
    ]
    rows += [(5000 + i, rows[40][1]) for i in range(60)]  # ties
    odd = [(9000, None), (9020, [0.0] * 16), (9040, [float("nan")] * 16), (9060, [1.0]),
           (9080, [None] * 16), (9100, [float("inf")] * 16), (9120, []), (None, [1.0] * 16),
           (40, rows[40][1])]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>")
    return df, [*rows, odd[-1]]


def test_recall_and_order(vectors):
    df, rows = vectors
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows])
    found = {}
    for r in search(df, F.col("vec_id") % 20 == 0, k=20, leaf_rows=64, shard_rows=500).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for query, near in found.items():
        near.sort()
        score = matrix @ matrix[np.flatnonzero(ids == query)[0]]
        exact = dict(zip(ids.tolist(), score.tolist()))
        assert [r for r, _, _ in near] == list(range(1, 21))
        assert all(s == pytest.approx(exact[i], rel=1e-12) and i != query for _, i, s in near)
        assert [(-s, i) for _, i, s in near] == sorted((-s, i) for _, i, s in near)
        others = np.flatnonzero(ids != query)
        best = others[np.lexsort((ids[others], -score[others]))][:20]
        hits += len({i for _, i, _ in near} & set(ids[best].tolist()))
    assert hits / (20 * len(found)) >= 0.9


def test_tiny_far_off_clusters(spark):
    rng = np.random.default_rng(6)
    middles = 50 * np.eye(24)
    sizes = [150] * 12 + [1, 1, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    rows = []
    for middle, n in zip(middles, sizes):
        rows += [middle + 0.3 * rng.standard_normal(24) for _ in range(n)]
    table = [(i, v.tolist()) for i, v in enumerate(rows)]
    table += [(1800, rows[1800].tolist())] * 30  # an id whose copies fill a leaf
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    # a low recall calibrates one visit
    found = search(df, F.lit(True), recall=0.05, leaf_rows=8, shard_rows=500).collect()
    assert Counter(r["query_id"] for r in found) == {i: 20 for i in range(len(rows))}
    assert all(r["query_id"] != r["vec_id"] for r in found)


def test_few_candidates(spark, vectors):
    df, _ = vectors
    few = df.filter("vec_id < 4")
    rows = search(few, F.lit(True), k=20).collect()
    assert Counter(r["query_id"] for r in rows) == {0: 3, 1: 3, 2: 3, 3: 3}
    assert search(df.filter("vec_id = 7"), F.lit(True)).count() == 0
    assert search(df.limit(0), F.lit(True)).count() == 0


# --- all of them -----------------------------------------------------------------------------


def test_empty_tables(no_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert score_texts(no_docs, F.lit(True), out="r").count() == 0
    assert remove_repeats(no_docs, out="r").count() == 0
    assert near_duplicates(no_docs, out="r").count() == 0
    assert pack(no_docs, path, keep=["doc_id"]).count() == 0


def test_columns_of_the_input_stay(docs):
    for df in (
        score_texts(docs, F.lit(True), out="r"),
        remove_repeats(docs, out="r"),
        near_duplicates(docs, out="r"),
    ):
        assert df.columns == [*docs.columns, "r"]
        assert {row["n_tokens"] for row in df.select("n_tokens").collect()} == {"own"}

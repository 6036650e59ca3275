"""Hard negatives, chat formatting and run detection, against plain versions."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberwall.llm import chat_format, hard_negatives
from emberwall.llm.chat_format import escaped, format_chats, learnt, parse
from emberwall.llm.hard_negatives import Heaps, mine, strassen
from emberwall.llm.queries import planted_periods
from emberwall.llm.run_detection import (
    Suffixes,
    WaveletTree,
    Words,
    find_runs,
    runs_of,
)

# --- hard negatives -----------------------------------------------------------------


@pytest.mark.parametrize(
    "shape", [(1, 1, 1), (3, 5, 2), (16, 17, 18), (17, 64, 33), (50, 63, 70), (40, 40, 40)]
)
def test_products_are_exact(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = (rng.integers(-(2**62), 2**62, s) for s in ((m, k), (k, n)))  # sums wrap
    assert (strassen(a, b) == a @ b).all()
    assert (strassen(a, np.asfortranarray(b)) == a @ b).all()


def test_heaps_do_not_depend_on_the_order_of_tiles():
    rng = np.random.default_rng(1)
    owner, score, id_ = (rng.integers(0, n, 3000) for n in (20, 9, 10_000))
    plain = {}
    for o, s, i in zip(owner.tolist(), score.tolist(), id_.tolist()):
        plain.setdefault(o, []).append((-s, i))
    for order in (np.arange(3000), rng.permutation(3000)):
        heaps = Heaps(20, 4)
        for part in np.array_split(order, 7):
            heaps.add(owner[part], score[part], id_[part])
        got = {}
        for o, s, i in zip(heaps.owner.tolist(), heaps.score.tolist(), heaps.id.tolist()):
            got.setdefault(o, []).append((-s, i))
        assert got == {o: sorted(x)[:4] for o, x in plain.items()}


def plain_negatives(rows, anchors, low=50, high=95):
    """(anchor, positive, rank, negative, positive score, negative score) by definition."""
    usable = []
    for id_, vector, label in rows:
        if label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((id_, [math.floor(256 * x) for x in vector], label))
    last = 2**63
    found = []
    for a, (id_, vector, label) in enumerate(usable):
        if id_ is None or not anchors(id_):
            continue
        scored = [
            (-sum(x * y for x, y in zip(vector, v)), last if i is None else i, i, other == label)
            for b, (i, v, other) in enumerate(usable)
            if a != b
        ]
        scored.sort(key=lambda s: s[:2])
        for minus, _, positive, _ in [s for s in scored if s[3]][:5]:
            near = [s for s in scored if not s[3] and low * -minus <= 100 * -s[0] <= high * -minus]
            for rank, (other_minus, _, negative, _) in enumerate(near[:3], 1):
                found.append((id_, positive, rank, negative, -minus, -other_minus))
    return found


def odd_vectors(seed=3, n=160, dims=12):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4)) if i % 3 else 0  # a third in one label
        centre = np.eye(dims)[label] * 0.7
        vector = [float(x) for x in centre + rng.normal(0, 0.4, dims)]
        rows.append((i, vector, label))
    rows += [rows[7], rows[8], rows[8]]  # repeated rows, one an anchor's
    rows += [(rows[0][0], rows[3][1], 2)]  # an id with two vectors
    rows += [(500, None, 1), (504, [0.5], None), (508, [None] + [0.1] * 11, 1)]
    rows += [(512, [float("nan")] * dims, 1), (516, [float("inf")] + [0.0] * 11, 1)]
    rows += [(520, [], 1), (524, [0.9, 0.2], 1), (None, rows[1][1], 2), (None, rows[1][1], 0)]
    rows += [(528, [0.0] * dims, 1)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int, row string, v string, heap int"


@pytest.mark.parametrize(
    "options",
    [{}, {"block_bytes": 12 * 8 * 20, "anchor_bytes": 12 * 8 * 7, "merge_at_once": 2}],
    ids=["one block", "many blocks"],
)
def test_negatives_as_by_definition(spark, options):
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, "own", "own", 1) for r in rows], SCHEMA).repartition(3)
    got = mine(df, F.col("vec_id") % 4 == 0, **options).collect()
    expected = plain_negatives(rows, lambda i: i % 4 == 0)
    assert len(expected) > 300
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_ties_and_windows_at_their_edges(spark):
    rows = [(0, [1.0, 0.0], 0), (4, [1.0, 0.0], 0), (1, [0.5, 0.0], 1), (2, [0.5, 9.0], 1)]
    rows += [(3, [0.95, 0.0], 1), (5, [0.96, 0.0], 1), (6, [0.49, 0.0], 1), (7, [0.5, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = mine(df, F.col("vec_id") == 0).orderBy("rank").collect()
    # 65,536 is the positive's score; 0.95 is 243 / 256, rounded down
    assert [(r.negative_id, r.negative_score) for r in got] == [(3, 62208), (1, 32768), (2, 32768)]


def test_no_vectors_and_sizes_that_do_not_fit(spark):
    kind = "vec_id long, embedding array<double>, label int"
    empty = spark.createDataFrame([], kind)
    assert mine(empty, F.lit(True)).collect() == []
    rows = [(0, [1e30], 0), (1, [1.0], 0), (2, [1.0], 0), (3, [0.7], 1)]
    got = mine(spark.createDataFrame(rows, kind), F.lit(True)).collect()
    assert {(r.anchor_id, r.positive_id, r.negative_id) for r in got} == {(1, 2, 3), (2, 1, 3)}


def test_other_names(spark):
    df = spark.createDataFrame(odd_vectors(n=40), SCHEMA.split(", row")[0])
    expected = mine(df, F.col("vec_id") % 4 == 0).collect()
    renamed = df.toDF("row", "v", "id")
    got = mine(renamed, F.col("row") % 4 == 0, id_column="row", label="id", vector="v").collect()
    assert expected and sorted(map(str, got)) == sorted(map(str, expected))


# --- chats --------------------------------------------------------------------------

PIECES = ["\\", "### ", "</turn>", ": ", "\n", "#", "<", " ", "a", "é", "/turn>", "### user: ", "日"]


def chats(seed=5, n=60):
    """(conversation, turn, role, text): texts of pieces that matter to the grammar."""
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "system", "a: b", "x\\", "### ", ":", "", None])
            text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12)))
            rows.append((conv, turn, role, text))
    rows += [(0, 0, "user", None), (None, 1, "user", "no id"), (None, 0, "assistant", "\\### ")]
    rows += [(1, 0, "assistant", "twice"), (1, 0, "assistant", "twice"), (2, None, "user", "first")]
    rows += [(900, 0, "assistant", "long \\</turn> é " * 60_000), (901, 0, "assistant", "")]
    rows += [(902, i, "assistant", f"{i} ### ") for i in range(3000)]
    return rows


def sources(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, *t[2:]))]
            for c, turns in found.items()}


@pytest.fixture(scope="module")
def formatted(spark):
    kind = "conv_id long, turn long, role string, text string, line string, span int, at int"
    rows = [(*r, "own", 1, 2) for r in chats()]
    return format_chats(spark.createDataFrame(rows, kind).repartition(5)).cache()


def plain_turns(text):
    """The grammar, read character by character."""
    turns, at = [], 0

    def read(controls, stop):
        nonlocal at
        out = []
        while not text.startswith(stop, at):
            assert at < len(text)
            assert not any(text.startswith(c, at) for c in controls)
            if text[at] == "\\":
                known = [c for c in ["\\", *controls, stop.strip("\n")] if text.startswith(c, at + 1)]
                if known:
                    out.append(known[0])
                    at += 1 + len(known[0])
                    continue
            out.append(text[at])
            at += 1
        at += len(stop)
        return "".join(out)

    while at < len(text):
        assert text.startswith("### ", at)
        at += 4
        turns.append((read([], ": "), read(["### "], "</turn>\n")))
    return turns


def test_chats_read_back(formatted):
    expected = sources(chats())
    got = formatted.withColumn("turns", parse(F.col("formatted"))).collect()
    assert {r.conv_id for r in got} == set(expected) and len(got) == len(expected)
    for row in got:
        source = expected[row.conv_id]
        assert [tuple(t) for t in row.turns] == source
        assert row.n_turns == len(source)
        if row.conv_id != 900:
            assert plain_turns(row.formatted) == source


def test_the_mask_holds_what_is_learnt(formatted):
    expected = sources(chats())
    for row in formatted.withColumn("said", learnt(F.col("formatted"), F.col("loss"))).collect():
        said = [text for role, text in expected[row.conv_id] if role == "assistant"]
        assert row.said == said
        raw = row.formatted.encode()
        for span in row.loss:
            cut = row.formatted[span.start : span.end]
            assert cut.encode() == raw[span.byte_start : span.byte_end]
            assert row.formatted[span.end :].startswith("</turn>\n")


def test_only_what_conflicts_is_escaped(spark):
    rows = [(0, 0, "user", r"C:\dir ## x </b>"), (1, 0, "user", r"a\b ### c"), (2, 0, "user", "\\\\")]
    kind = "conv_id long, turn long, role string, text string"
    got = {r.conv_id: r.formatted for r in format_chats(spark.createDataFrame(rows, kind)).collect()}
    assert got == {
        0: "### user: C:\\dir ## x </b></turn>\n",
        1: "### user: a\\b \\### c</turn>\n",
        2: "### user: \\\\\\\\</turn>\n",
    }


def test_what_is_no_conversation_does_not_parse(spark):
    bad = ["### user: a", "x### user: a</turn>\n", "### user a</turn>\n", "### user: ### a</turn>\n"]
    df = spark.createDataFrame([(x,) for x in bad], "t string").select(parse(F.col("t")).alias("p"))
    assert [r.p for r in df.collect()] == [None] * len(bad)


def test_formatting_runs_no_python(formatted, spark):
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_chats(empty).collect() == []


def test_one_shuffle(spark):
    rows = spark.range(100).selectExpr("id % 9 AS conv_id", "id AS turn", "'user' AS role", "'a' AS text")
    plan = format_chats(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_bytes_that_are_no_text(spark):
    df = spark.sql("SELECT 1L AS conv_id, 0L AS turn, 'user' AS role, CAST(X'61FF62' AS string) AS text")
    assert format_chats(df).first().formatted == "### user: a\ufffdb</turn>\n"


def test_escapes_are_undone_by_level(spark):
    texts = ["".join(p) for p in zip(PIECES, PIECES[3:] + PIECES[:3], PIECES[7:] + PIECES[:7])]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for controls in (chat_format._TEXT_CONTROLS, chat_format._ROLE_CONTROLS):
        whole = chat_format.unescaped(escaped(F.col("t"), controls, 2), controls)
        assert df.filter(whole != F.col("t")).count() == 0


# --- runs ---------------------------------------------------------------------------


def plain_runs(words, least=6, times=4):
    """(start, length, period), by comparing words at all distances."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def periodic_texts(rng, count=30):
    """Random words of small alphabets, and periods inside periods."""
    texts = []
    for _ in range(count):
        signs = [b"a", b"b", b"c"][: rng.randint(1, 3)]
        words = [rng.choice(signs) for _ in range(rng.randint(0, 150))]
        kind = rng.randint(0, 3)
        if kind == 1:
            part = [rng.choice([b"a", b"b"]) for _ in range(rng.randint(1, 25))]
            words = words[:20] + part * rng.randint(1, 9) + part[: rng.randint(0, len(part))]
        elif kind == 2:
            part = [b"a"] * rng.randint(1, 12) + [b"b"] * rng.randint(1, 12)
            words = part * rng.randint(3, 8) + part[: rng.randint(0, len(part))]
            words = words + [b"c"] + words
        elif kind == 3:
            part = [rng.choice([b"a", b"b"]) for _ in range(3)] * rng.randint(1, 5) + [b"b"]
            part = part + [b"x"] + part * 2
            words = part * rng.randint(3, 7) + part[: rng.randint(0, len(part))]
        texts.append(words)
    return texts


@pytest.mark.parametrize("seed", range(12))
def test_runs_as_by_definition(seed):
    texts = periodic_texts(random.Random(seed), 60)
    owner, *values = runs_of(texts)
    for i, words in enumerate(texts):
        own = [tuple(v) for v in np.stack(values, 1)[owner == i].tolist()]
        assert own == plain_runs(words)


def test_other_bounds():
    texts = periodic_texts(random.Random(99))
    for least, times in ((4, 4), (30, 4), (6, 7)):
        owner, *values = runs_of(texts, least, times)
        for i, words in enumerate(texts):
            assert [tuple(v) for v in np.stack(values, 1)[owner == i].tolist()] == plain_runs(
                words, least, times
            )


def test_range_successor():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 64, 100):
        values = rng.permutation(n)
        tree = WaveletTree(values)
        low, high = np.sort(rng.integers(0, n + 1, (2, 500)), axis=0)
        x = rng.integers(0, n + 3, 500)
        plain = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(low, high, x)]
        assert tree.successor(low, high, x).tolist() == plain


def test_suffixes_are_in_order_and_agree():
    texts = periodic_texts(random.Random(4), 8)
    words = Words.of(texts)
    suffixes = Suffixes(words)
    first = words.first

    def suffix(i):
        return words.number[i : words.last[i]].tolist()

    order = suffixes.order.tolist()
    keys = [(first[i], suffix(i)) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(len(words.number)))
    pairs = [(i, j) for i in range(0, len(order), 7) for j in range(i + 1, len(order), 5)]
    pairs = np.array([(i, j) for i, j in pairs if first[i] == first[j]])
    x, y = pairs.T
    agree, before = suffixes.agree(x, y), suffixes.agree_before(x, y)
    for i, j, a, b in zip(x.tolist(), y.tolist(), agree.tolist(), before.tolist()):
        s, t = suffix(i), suffix(j)
        assert a == next((k for k, (p, q) in enumerate(zip(s, t)) if p != q), min(len(s), len(t)))
        s, t = words.number[first[i] : i][::-1], words.number[first[j] : j][::-1]
        assert b == next((k for k, (p, q) in enumerate(zip(s, t)) if p != q), min(len(s), len(t)))


@pytest.fixture(scope="module")
def repetitive(texts):
    """The shared texts, and periodic ones: of one word, very long, with white space that
    words leave out, and words equal in all but case."""
    rows = [(i, t) for i, t in texts]
    rows += [(100 + i, b" ".join(w).decode()) for i, w in enumerate(periodic_texts(random.Random(8)))]
    rows += [(200, "na " * 9), (201, "\tna\r\n" * 40_000), (202, "Na na " * 3), (203, "ä b\x0bc " * 12)]
    rows += [(204, "x\u00a0y " * 6), (205, "x y " * 3 + "x"), (206, "x y " * 4)]
    return rows


def test_operator_on_odd_texts(spark, repetitive):
    df = spark.createDataFrame(
        [(i, t, "own", 1) for i, t in repetitive],
        "doc_id long, text string, runs string, n_words int",
    ).repartition(3)
    got = find_runs(df, out="found").collect()
    assert len(got) == len(repetitive)
    for row in got:
        words = (row.text or "").encode().split()
        expected = plain_runs(words) if len(words) < 5000 else None
        found = [(r.start, r.length, r.period) for r in row.found.runs]
        if row.doc_id == 201:
            expected = [(0, 40_000, 1)]
        if expected is not None:
            assert found == expected
        dropped = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = [w for i, w in enumerate(words) if i not in dropped]
        assert row.found.collapsed == b" ".join(kept).decode()
        assert row.found.n_words == len(words) and row.runs == "own"


def test_no_texts_and_too_few_periods(no_docs, docs):
    assert find_runs(no_docs, out="found").collect() == []
    with pytest.raises(ValueError):
        find_runs(docs, times=3)


def test_query_as_by_definition(spark, repetitive, tmp_path):
    from emberwall.llm.queries import op13_periodic_runs

    rows = [*repetitive, (None, None), (1_000_000_007, "a b c d e f g h i j " * 30)]
    rows += [(300 + i, " ".join(f"w{k % 97}" for k in range(40 + i))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    expected = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        n = len(words)
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 5000:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-r[1] * 10**9 // r[2], r[0], r[2])) if runs else (None,) * 3
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        shown = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        milli = 1000 * best[1] // best[2] if runs else None
        hashes = [hashlib.sha256(x).hexdigest() for x in (shown.encode(), kept)]
        expected.append((doc_id, len(runs), *best, milli, *hashes))
    got = [tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()]
    long = {r[0] for r in rows if len((r[1] or "").split()) > 5000}
    assert sorted(map(str, [r for r in got if r[0] not in long])) == sorted(map(str, expected))
    assert sum(1 for r in expected if r[1]) > 20


def test_planted_words_stay_within_the_text(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 50))) for i in range(400)] + [(None, "a"), (5, None)]
    got = planted_periods(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "text"] and got.count() == len(rows)
    for row in got.collect():
        if row.doc_id is not None and row.text is not None:
            assert len(row.text.split()) == row.doc_id % 50 or row.doc_id == 5

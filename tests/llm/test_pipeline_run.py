"""The whole pipeline on a folder of documents, against plain Python of all five stages."""

import random
import re
import string
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from emberwall.llm.oracle import oracle_sql
from emberwall.session import shared_folder


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def prose(rng, words, pool):
    out = []
    for i in range(words):
        out.append(rng.choice(pool))
        out.append(".\n" if i % 13 == 12 else " ")
    return "".join(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(17)
    pool = [f"w{k}{'aeiouü'[k % 6]}n" for k in range(900)]
    texts = [prose(rng, rng.randint(70, 220), pool) for _ in range(22)]
    texts += [texts[0], texts[0], texts[1], texts[2].replace("w7", "w8"), texts[3] + " end"]
    shared, notice = prose(rng, 60, pool), prose(rng, 45, pool)
    texts += [prose(rng, 80, pool) + shared + prose(rng, 60, pool) for _ in range(4)]
    texts += [prose(rng, 90, pool) + notice + shared for _ in range(2)]
    key = "".join(rng.choice(string.hexdigits.lower()) for _ in range(32))
    texts += [prose(rng, 90, pool) + f' password = "hunter22" and {key} ü AKIA{"Q7" * 10} ' + texts[5][:40]]
    texts += [prose(rng, 90, pool) + " api_key: abcdef123456 token=zzzzzz9\n"]
    texts += ["For " * 90, "$$$ ".join(prose(rng, 70, pool).split()), "short text", "", None]
    texts += [prose(rng, 3500, pool)]
    return [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]


def kept_by_rules(folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = connection.execute(f"SELECT doc_id FROM ({oracle_sql()['op4_quality_rules']}) WHERE kept")
    return {row[0] for row in found.fetchall()}


def fingerprint(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) > len(hashes) / 2)


def first_of_groups(texts):
    prints = {i: fingerprint(t) for i, t in texts.items()}
    group = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for i, a in prints.items():
            for j, b in prints.items():
                if (a ^ b).bit_count() <= 2 and group[j] < group[i]:
                    group[i], changed = group[j], True
    return {i: t for i, t in texts.items() if group[i] == i}


def without_repeats(texts, length=200):
    raw = {i: t.encode() for i, t in texts.items()}
    starts = Counter(b[k : k + length] for b in raw.values() for k in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = set()
        for k in range(len(b) - length + 1):
            if starts[b[k : k + length]] > 1:
                gone.update(range(k, k + length))
        left = bytes(x for k, x in enumerate(b) if k not in gone)
        out[i] = left.decode("utf-8", "ignore") if gone else texts[i]
    return out


ASSIGN = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def without_secrets(text):
    spans = [m.span() for m in re.finditer(ASSIGN, text, re.A) if len(m[1]) >= 6]
    spans += [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    parts, done = [], 0
    for start, end in sorted(spans):
        if start >= done:
            parts += [text[done:start], "[SECRET]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def test_run_as_by_plain_python(spark, rows, tmp_path):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    got = result.collect()

    kept = kept_by_rules(tmp_path)
    texts = {i: t or "" for i, t, *_ in rows if i in kept}
    assert 25 <= len(texts) < len(rows)
    first = first_of_groups(texts)
    assert len(first) <= len(texts) - 3
    cut = without_repeats(first)
    assert sum(cut[i] != first[i] for i in cut) >= 6
    clean = {i: without_secrets(t) for i, t in cut.items()}
    assert sum(clean[i] != cut[i] for i in clean) == 2
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for i, text in clean.items():
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            pieces[i, piece] = (start, ids[start : start + 4096])
    assert max(piece for _, piece in pieces) >= 1
    assert {(r.doc_id, r.piece): (r.start, list(r.ids)) for r in got} == pieces and len(got) == len(pieces)

    sequences = defaultdict(list)
    for row in got:
        assert row.length == len(row.ids)
        sequences[row.sequence_id].append((row.offset, row.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(sequences) == -(-sum(len(ids) for _, ids in pieces.values()) // 4096)


def test_run_leaves_its_result_only(spark, rows, tmp_path, monkeypatch):
    """No table of the catalog and no folder but that of the last stage stays."""
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows[:12], columns).write.parquet(f"{tmp_path}/documents.parquet")
    folder = tmp_path / "shared"
    monkeypatch.setattr("emberwall.session.shared_folder", lambda spark: f"file:{folder}")
    before = {t.name for t in spark.catalog.listTables()}
    result = corpus_pipeline.run(spark, str(tmp_path))
    left = [p.name for p in (folder / "emberwall").glob("*/*")]
    assert left == ["best-fit_packing"] and result.count() > 0
    assert {t.name for t in spark.catalog.listTables()} == before
    assert shared_folder(spark)


def test_run_on_odd_tables(spark, tmp_path, docs, no_docs):
    """Clashing names, nulls, a very long text; and no rows at all."""
    for name, table in (("odd", docs), ("none", no_docs)):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert "ids" in packed.columns
        ids = packed.select("doc_id").distinct().count()
        assert ids > 25 if name == "odd" else ids == 0
        over = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096")
        assert over.count() == 0

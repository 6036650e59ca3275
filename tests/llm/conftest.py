import random
import string

import pytest

CLASHING = [
    "n_tokens", "score", "kept", "value", "leader", "first", "root", "part", "length", "block",
    "docs", "words", "learn", "made", "scanned", "row", "id", "label", "n_chars",
]
SCHEMA = "doc_id long, text string, " + ", ".join(
    f"{c} {'long' if c == 'n_chars' else 'string'}" for c in CLASHING
)


def prose(rng, words, vocabulary=400):
    """Lines of made-up words."""
    pool = [f"w{k}{'aeiou'[k % 5]}n" for k in range(vocabulary)]
    out = []
    for i in range(words):
        out.append(rng.choice(pool))
        out.append(".\n" if i % 11 == 10 else " ")
    return "".join(out)


@pytest.fixture(scope="session")
def texts():
    """(id, text): prose, exact and near copies, shared passages, junk, secrets, odd
    characters, empty and very long texts, nulls, and a repeated row."""
    rng = random.Random(7)
    found = [prose(rng, rng.randint(60, 200)) for _ in range(30)]
    found += [found[0], found[0], found[1] + " end", found[2].replace("w7", "w8")]
    passage = prose(rng, 60)
    found += [prose(rng, 70) + passage + prose(rng, 70) for _ in range(3)]
    found += [" | ".join(prose(rng, 80).split()), "For " * 90, "$$$ ".join(prose(rng, 70).split())]
    token = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(48))
    found += [
        f'x password = "{token[:20]}" y AKIA{"Q7" * 10} z {"0f" * 16} ü token: abc',
        f"é key {token} and {'aAbB0' * 9}",
    ]
    found += ["", " \t\n", "a", "Ab cD", "日本 語 ñ é b c", "<|endoftext|> x", None]
    found += [prose(rng, 30_000)]
    rows = list(enumerate(found))
    return [*rows, rows[3], (None, found[4]), (None, None)]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts, with columns named like results."""
    own = [None if c == "n_chars" else "own" for c in CLASHING]
    rows = [(i, t, *own) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def by_text():
    """Results as a dictionary from (id, text) to the result, and that rows with the
    same id and text agree."""

    def collect(df, out):
        found = {}
        for row in df.collect():
            value = row[out].asDict(recursive=True) if hasattr(row[out], "asDict") else row[out]
            assert found.setdefault((row["doc_id"], row["text"]), value) == value
        return found

    return collect

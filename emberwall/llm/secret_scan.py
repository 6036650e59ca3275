"""Secrets in texts: fixed patterns, and strings that look drawn at random.

Patterns find assignments, access keys and long hex runs. Other long tokens,
runs of the base64 and of the base64url alphabet, are put to a battery of tests of
the encoding they seem to have, which may be written in groups with dashes between:
chi-squared for an even use of the alphabet, runs about its middle, correlation of
neighbours, vowels and consonants by turns, letters that are frequent in languages,
pairs of letters that are frequent in the words of the corpus, and the number of signs
such as slashes. Fisher's method joins the p-values. A token is ruled out as random by
the Benjamini-Hochberg procedure over all tokens of its length class in the whole
corpus, each different token counted once; the share of secrets among what is ruled out
that it allows grows for short tokens, on which the tests can tell little. However many
tokens are not random, none is ruled out with a p-value above ``MISSED``, which loses one
or two in a hundred of the random tokens. What isn't ruled out is reported as kind
``random``, unless it overlaps a pattern's span; where such tokens overlap they are one
span.

Null and empty texts have no spans; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwall.llm.common import (
    Rows, column_bytes, free_name, map_batches, with_result, worker_memory,
)
from emberwall.llm.words import LOWER, Hasher, chunks

# The patterns of the base kinds, in the order they are listed.
ASSIGN = (
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

#: Shortest token put to the tests.
MIN_TOKEN = 20
#: Length classes: from so many characters on, and the share for the procedure.
CLASSES = ((MIN_TOKEN, 0.30), (28, 0.20), (40, 0.10), (64, 0.05))
#: The largest p-value that can be ruled out. Of drawn tokens 0.1 to 1.7 % are below
#: it, by length and encoding, as the tails of the tests are approximate.
MISSED = 0.005
BINS = 1000

SCANNED = "spans array<struct<kind:string,start:int,end:int>>"

_DIGITS = "0123456789"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
#: Encodings in the order they are tried: name, alphabet, kinds of character needed.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef", (_DIGITS, _LOWER)),
    ("HEX", _DIGITS + "ABCDEF", (_DIGITS, _UPPER)),
    ("base32", _UPPER + "234567", (_UPPER, _DIGITS)),
    ("lower36", _DIGITS + _LOWER, (_DIGITS, _LOWER)),
    ("upper36", _DIGITS + _UPPER, (_DIGITS, _UPPER)),
    ("base62", _DIGITS + _UPPER + _LOWER, (_DIGITS, _UPPER, _LOWER)),
    ("upper26", _UPPER, (_UPPER,)),
    ("lower26", _LOWER, (_LOWER,)),
    ("letters", _UPPER + _LOWER, (_UPPER, _LOWER)),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", (_UPPER, _LOWER)),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", (_UPPER, _LOWER)),
    ("digits", _DIGITS, (_DIGITS,)),
)
_HEX_SIGNS = set(_DIGITS + "abcdefABCDEF")
_SIGNS = "+/-_"
_VOWELS = "aeiouy"
#: How many in a thousand letters of English, German, French and Spanish, about.
_LETTERS = dict(zip("enasitrolducmhpgbfvwyzkqjx", (
    150, 82, 78, 72, 72, 70, 66, 56, 44, 43, 43, 32, 27, 33, 22, 18, 14, 13, 12, 11, 8, 6, 6, 5, 3, 2,
)))
_LOGS = {c: math.log(n) for c, n in _LETTERS.items()}
_LOG_MEAN = sum(_LOGS.values()) / len(_LOGS)
_LOG_SPREAD = sum((x - _LOG_MEAN) ** 2 for x in _LOGS.values()) / len(_LOGS)


def infer_encoding(token: str) -> str | None:
    """The alphabet of the first encoding that fits, or None; letters alone must be
    as many as a token that is tested has."""
    used = set(token)
    if len(token) < MIN_TOKEN and not used & {*_DIGITS, *_SIGNS}:
        return None
    for _, alphabet, kinds in ENCODINGS:
        if used <= set(alphabet) and all(used & set(kind) for kind in kinds):
            return alphabet
    return None


def reading(token: str) -> tuple[str, str] | None:
    """The token as it is tested, and the alphabet: hex digits of either case are folded,
    and where no encoding fits, dashes and underscores are taken as marks between groups,
    unless all groups are numbers."""
    if set(token) <= _HEX_SIGNS and set(token) & set(_DIGITS) and token.lower() != token != token.upper():
        return token.lower(), _DIGITS + "abcdef"
    alphabet = infer_encoding(token)
    if alphabet is None:
        joined = token.replace("-", "").replace("_", "")
        if joined == token or len(joined) < MIN_TOKEN or joined.isdigit():
            return None
        return reading(joined)
    return token, alphabet


class PairTable:
    """How usual pairs of letters are, from ``counts`` of all of them (26 x 26)."""

    def __init__(self, counts: np.ndarray):
        smooth = counts + 1.0
        self.logs = np.log(smooth / smooth.sum())
        self.mean = float(self.logs.mean())
        self.spread = float(self.logs.var())
        # of two pairs that share a letter
        self.shared = float((self.logs.mean(axis=0) * self.logs.mean(axis=1)).mean() - self.mean**2)

    def tail(self, token: str) -> float | None:
        """Upper tail of how usual the token's pairs of letters are, or None if there are
        too few to tell, or the table tells nothing."""
        place = np.frombuffer(token.lower().encode(), np.uint8).astype(np.int64) - ord("a")
        letter = (place >= 0) & (place < 26)
        pair = letter[:-1] & letter[1:]
        n = int(pair.sum())
        if n < 8 or self.spread < 1e-3:
            return None
        over = float(self.logs[place[:-1][pair], place[1:][pair]].sum()) - n * self.mean
        chained = int((pair[:-1] & pair[1:]).sum())
        spread = max(n * self.spread + 2 * chained * self.shared, 1e-9)
        return 0.5 * math.erfc(over / math.sqrt(2 * spread))


def _turns_tail(token: str) -> float | None:
    """Upper tail of how often a vowel and a consonant are neighbours, which in words
    they mostly are, or None if too few letters are neighbours to tell."""
    marks = [c in _VOWELS if c in _LOWER else None for c in token.lower()]
    pairs = [(a, b) for a, b in zip(marks, marks[1:]) if a is not None and b is not None]
    if len(pairs) < 8:
        return None
    vowel = len(_VOWELS) / len(_LOWER)
    mean = 2 * vowel * (1 - vowel)
    chained = sum(
        None not in three for three in zip(marks, marks[1:], marks[2:])
    )  # pairs that share a letter
    spread = len(pairs) * mean * (1 - mean) + 2 * chained * (mean / 2 - mean * mean)
    turns = sum(a != b for a, b in pairs)
    return 0.5 * math.erfc((turns - 0.5 - len(pairs) * mean) / math.sqrt(2 * spread))


def _letters_tail(token: str) -> float | None:
    """Upper tail of how frequent the letters are in the languages, or None if there
    are too few to tell."""
    logs = [_LOGS[c] for c in token.lower() if c in _LOGS]
    if len(logs) < 8:
        return None
    over = sum(logs) - len(logs) * _LOG_MEAN
    return 0.5 * math.erfc(over / math.sqrt(2 * len(logs) * _LOG_SPREAD))


def _signs_tail(n: int, signs: int) -> float:
    """Upper tail of how many of ``n`` characters are one of two signs in 64, given
    that there is one."""
    share = 2 / 64
    none = (1 - share) ** n
    below, term = 0.0, none
    for k in range(1, signs):
        term *= (n - k + 1) / k * share / (1 - share)
        below += term
    return min(1.0, max(1e-300, 1 - below / (1 - none)))


def _normal_tail(z: float) -> float:
    """Both tails of the normal distribution."""
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, freedom: int) -> float:
    """Upper tail of chi-squared by the cube-root approximation."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * freedom)
    return 0.5 * math.erfc(((x / freedom) ** (1 / 3) - 1 + spread) / math.sqrt(2 * spread))


def randomness(token: str, alphabet: str, pairs: PairTable | None = None) -> float:
    """One p-value for "drawn evenly and independently from the alphabet"."""
    place = np.array([alphabet.index(c) for c in token], float)
    n, size = len(place), len(alphabet)
    bins = max(2, min(size, n // 5))
    counts = np.bincount((place * bins // size).astype(int), minlength=bins)
    edges = np.bincount((np.arange(size) * bins // size).astype(int), minlength=bins)
    expected = n * edges / size
    p = [_chi2_tail(float(((counts - expected) ** 2 / expected).sum()), bins - 1)]

    high = place >= size / 2
    above = int(high.sum())
    below = n - above
    if above and below:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * above * below / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        p.append(_normal_tail((runs - mean) / math.sqrt(max(spread, 1e-9))))
    else:
        p.append(2.0 ** (1 - n))

    off = place - place.mean()
    power = float((off * off).sum())
    follow = float((off[1:] * off[:-1]).sum()) / power if power else 1.0
    p.append(_normal_tail((follow + 1 / n) * math.sqrt(n)))

    if size > 16:
        tails = [_turns_tail(token), _letters_tail(token), pairs and pairs.tail(token)]
        p += [x for x in tails if x is not None]
    signs = sum(c in _SIGNS for c in token)
    if signs:
        p.append(_signs_tail(n, signs))

    # Fisher: the tail of chi-squared with two degrees of freedom per test, exactly.
    half = -sum(math.log(max(x, 1e-300)) for x in p)
    return min(1.0, math.exp(-half) * sum(half**k / math.factorial(k) for k in range(len(p))))


def length_class(length: int) -> int:
    return sum(length >= start for start, _ in CLASSES) - 1


class Scanner:
    def __init__(self, pairs: np.ndarray | None = None):
        self.pairs = None if pairs is None else PairTable(pairs)
        self.assign = re.compile(ASSIGN, re.I | re.A)
        self.access = re.compile(ACCESS)
        self.hex = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
        self.hex_bytes = re.compile(rb"[0-9a-f]{%d,}" % MIN_HEX)
        self.tokens = [
            re.compile(rb"[A-Za-z0-9%s]{%d,}={0,2}" % (signs, MIN_TOKEN))
            for signs in (rb"+/", rb"_-")
        ]
        self.hasher = Hasher()

    def base(self, text: str, low: bytes, has_hex: bool) -> list[tuple[str, int, int]]:
        found = []
        names = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")
        if any(name in low for name in names):
            for m in self.assign.finditer(text):
                if len(m[2]) >= MIN_ASSIGN:
                    found.append((m.start(), 0, m.end()))
        if b"akia" in low:
            for m in self.access.finditer(text):
                if m.end() - m.start() >= MIN_ACCESS:
                    found.append((m.start(), 1, m.end()))
        if has_hex:
            found += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return [(KINDS[kind], start, end) for start, kind, end in sorted(found)]

    def scan(self, texts: list[bytes]):
        """Base spans and tried tokens (start, end, class, p) of each text, in
        code points."""
        long_words: list[list[tuple[int, int]]] = [[] for _ in texts]
        for part in chunks(texts, self.hasher):
            long = np.flatnonzero(part.ends - part.starts >= MIN_TOKEN)
            owner = np.searchsorted(part.offsets, part.starts[long], "right") - 1
            begin = part.offsets[owner]
            for i, a, b in zip(owner, part.starts[long] - begin, part.ends[long] - begin):
                long_words[part.first + i].append((int(a), int(b)))
        for text, words in zip(texts, long_words):
            low = text.translate(LOWER)
            has_hex = any(self.hex_bytes.search(text, a, b) for a, b in words)
            whole = text.decode("utf-8", "replace")
            base = self.base(whole, low, has_hex)
            tried = []
            for a, b in words:
                spans = {m.span(): m for run in self.tokens for m in run.finditer(text, a, b)}
                for _, m in sorted(spans.items()):
                    token = m[0].rstrip(b"=").decode()
                    known = reading(token)
                    if known is None:
                        continue
                    start = len(text[: m.start()].decode("utf-8", "replace"))
                    end = start + m.end() - m.start()
                    if any(start < e and s < end for _, s, e in base):
                        continue
                    p = randomness(*known, self.pairs)
                    tried.append((start, end, length_class(len(known[0])), p))
            yield base, tried


def step_of(p: float) -> int:
    return min(int(p * BINS), BINS - 1)


def excuse_thresholds(counts: DataFrame) -> list[float]:
    """The largest p-value that is ruled out as random, at most ``MISSED``, per length
    class, from rows (``class``, ``step``, ``n``) of all tokens. The sums that come to the driver are one
    per class and step, whatever the data."""
    table = np.zeros((len(CLASSES), BINS))
    for kind, at, n in counts.groupBy("class", "step").agg(F.sum("n")).collect():
        table[kind, at] = n
    out = []
    for (_, share), row in zip(CLASSES, table):
        total = row.sum()
        below = np.cumsum(row)
        tops = np.arange(1, BINS + 1) / BINS
        few = tops <= MISSED + 1e-9
        good = np.flatnonzero(few & (below > 0) & (tops * total <= share * below))
        out.append(float(tops[good[-1]]) if len(good) else 0.0)
    return out


def letter_pairs(docs: DataFrame, text: str) -> np.ndarray:
    """How often each letter follows each other one in words too short to be tested, over
    all texts, without case. What comes to the driver is 26 x 26 sums."""

    def run(batches: Rows) -> Rows:
        worker_memory("")
        hasher, counts = Hasher(), np.zeros(26 * 26, np.int64)
        for batch in batches:
            for part in chunks(column_bytes(batch.column(0)), hasher, lower=True):
                place = part.data.astype(np.int64) - ord("a")
                letter = (place >= 0) & (place < 26)
                long = np.flatnonzero(part.ends - part.starts >= MIN_TOKEN)
                for a, b in zip(part.starts[long], part.ends[long]):
                    letter[a:b] = False
                pair = letter[:-1] & letter[1:]
                found = place[:-1][pair] * 26 + place[1:][pair]
                counts += np.bincount(found, minlength=26 * 26)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(26 * 26), pa.int32()), pa.array(counts)], ["pair", "n"]
        )

    table = np.zeros(26 * 26, np.int64)
    found = map_batches(docs.select(F.col(f"`{text}`")), run, "pair int, n long")
    for pair, n in found.groupBy("pair").agg(F.sum("n")).collect():
        table[pair] = n
    return table.reshape(26, 26)


def count_steps(docs: DataFrame, text: str, pairs: np.ndarray | None = None) -> DataFrame:
    """Different tested tokens per length class and step of the p-value. A token goes
    once per batch, as a hash, and copies are combined before the shuffle."""

    def run(batches: Rows) -> Rows:
        worker_memory("")
        scanner = Scanner(pairs)
        for batch in batches:
            found = {}
            texts = column_bytes(batch.column(0))
            for text, (_, tried) in zip(texts, scanner.scan(texts)):
                whole = text.decode("utf-8", "replace") if tried else ""
                for start, end, kind, p in tried:
                    token = whole[start:end].rstrip("=").encode()
                    digest = hashlib.blake2b(token, digest_size=8).digest()
                    found[int.from_bytes(digest, "little", signed=True)] = kind, step_of(p)
            kind, step = zip(*found.values()) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.int64()), pa.array(kind, pa.int32()),
                 pa.array(step, pa.int32())],
                ["token", "class", "step"],
            )

    texts = docs.select(F.col(f"`{text}`"))
    tokens = map_batches(texts, run, "token long, class int, step int").distinct()
    return tokens.groupBy("class", "step").agg(F.count(F.lit(1)).alias("n"))


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    out: str = "secrets",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (of its columns those in ``keep``, by default all) with an array
    ``out`` of (``kind``, ``start``, ``end``), in code points, by start, then by
    kind as listed in ``KINDS``.

    Texts are scanned three times: p-values need the pairs of letters of the whole corpus,
    the verdict on tested tokens its p-values, and a scan costs less than storing texts.
    """
    at = docs.columns.index(text)
    pairs = letter_pairs(docs, text)
    limits = excuse_thresholds(count_steps(docs, text, pairs))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def prepare():
        scanner = Scanner(pairs)

        def compute(batch: pa.RecordBatch):
            found = []
            for base, tried in scanner.scan(column_bytes(batch.column(at))):
                claimed: list[tuple[str, int, int]] = []
                for start, end, kind, p in tried:
                    if (step_of(p) + 1) / BINS <= limits[kind]:
                        continue
                    if claimed and start < claimed[-1][2]:
                        _, start, before = claimed.pop()
                        end = max(end, before)
                    claimed.append(("random", start, end))
                every = sorted([*base, *claimed], key=lambda s: (s[1], KINDS.index(s[0])))
                found.append([dict(zip(("kind", "start", "end"), s)) for s in every])
            return [("spans", pa.array(found, pa.list_(span)))]

        return compute

    made = free_name(docs, "scanned")
    scanned = with_result(docs, made, SCANNED, prepare, keep)
    columns = [F.col(f"`{c}`") for c in scanned.columns if c != made]
    return scanned.select(*columns, F.col(f"`{made}`.spans").alias(out))


def redact(docs: DataFrame, text: str, spans: str, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each run of overlapping spans in ``text`` replaced by ``mark``."""
    at, where = docs.columns.index(text), docs.columns.index(spans)

    def run(batches: Rows) -> Rows:
        for batch in batches:
            new = []
            rows = zip(batch.column(at).to_pylist(), batch.column(where).to_pylist())
            for value, found in rows:
                if not found:
                    new.append(value)
                    continue
                parts, done = [], 0
                for s in found:
                    if s["start"] >= done:
                        parts += [value[done : s["start"]], mark]
                    done = max(done, s["end"])
                new.append("".join([*parts, value[done:]]))
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_batches(docs, run, T.StructType(docs.schema.fields))

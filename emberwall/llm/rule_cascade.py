"""Quality rules as a short-circuit cascade.

Every rule looks at a text and may reject it. A sample of the documents tells
what a rule costs per text and how much it rejects; rules run in the order of
rejections per second, each on the texts that all before it let pass. The order
changes the work, never the verdict.

Null and empty texts have no words and fail the base rule. Repeated rows are
judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwall.llm.common import Rows, column_bytes, map_batches, with_result, worker_memory
from emberwall.llm.words import (
    Hasher, chunks, distinct_per_text, mix, owners, repeated_words,
)

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, rejected_by string"
)

# Fixed values of the base rule and the characters that count as symbols.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def text_metrics(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The five counts of every text."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found: dict[str, list[np.ndarray]] = {name: [] for name in names}
    hasher = Hasher()
    for part in chunks(texts, hasher):
        n = part.last - part.first
        words = part.word_offsets
        found["n_words"].append(np.diff(words))
        begins = (part.data & 0xC0) != 0x80
        found["word_chars"].append(part.per_text(begins & ~part.space))
        found["n_symbols"].append(part.per_text(_SYMBOL[part.data]))

        # Lines with a word, by text and hash; the last newline of a text ends it.
        ends = np.flatnonzero(part.data == 10)
        starts = np.concatenate(([0], ends[:-1] + 1))
        filled = np.searchsorted(part.starts, starts) < np.searchsorted(part.starts, ends)
        starts, ends = starts[filled], ends[filled]
        text = np.searchsorted(part.offsets, starts, "right") - 1
        line = mix(hasher.spans(part.sums, starts, ends) + mix(text.astype(np.uint64)))
        lines = np.bincount(text, minlength=n)
        found["n_dup_lines"].append(lines - distinct_per_text(line, text, n))

        owner = owners(words)
        repeated = repeated_words(part.word_hashes(), owner)
        found["n_repeat_words"].append(np.bincount(owner[repeated], minlength=n))
    none = np.zeros(0, np.int64)
    return {k: np.concatenate([none, *v]) for k, v in found.items()}


@dataclass(frozen=True)
class Rule:
    """``rejects(text, metrics)`` looks at one text and its five counts."""

    name: str
    rejects: Callable[[bytes, dict], bool]


def _many_symbols(text: bytes, m: dict) -> bool:
    return m["n_symbols"] * 100 > 10 * m["word_chars"]


def _word_length(text: bytes, m: dict) -> bool:
    return not 2 * m["n_words"] <= m["word_chars"] <= 20 * m["n_words"]


def _shouting(text: bytes, m: dict) -> bool:
    return 10 * text.count(b"!") > 3 * m["n_words"]


def _piped(text: bytes, m: dict) -> bool:
    return 10 * text.count(b" | ") > 2 * m["n_words"]


def _repeated_lines(text: bytes, m: dict) -> bool:
    lines = sum(1 for line in text.split(b"\n") if line.strip())
    return 10 * m["n_dup_lines"] > 5 * lines


def _one_word(text: bytes, m: dict) -> bool:
    """One word makes up over 30 percent of the text."""
    from collections import Counter

    words = Counter(text.split())
    return max(words.values(), default=0) * 100 > 30 * m["n_words"]


def _few_letters(text: bytes, m: dict) -> bool:
    letters = sum(map(str.isalpha, text.decode("utf-8", "replace")))
    return 2 * letters < m["word_chars"]


#: Rules that follow the base rule, as written; the sample decides their order.
RULES = (
    Rule("one_word", _one_word),
    Rule("few_letters", _few_letters),
    Rule("repeated_lines", _repeated_lines),
    Rule("many_symbols", _many_symbols),
    Rule("shouting", _shouting),
    Rule("piped", _piped),
    Rule("word_length", _word_length),
)


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    few = m["n_words"] < MIN_WORDS
    return few | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def _row(m: dict[str, np.ndarray], i: int) -> dict:
    return {name: int(values[i]) for name, values in m.items()}


def measure_rules(
    docs: DataFrame,
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    sample_rows: int = 2000,
    seed: int = 5,
) -> list[tuple[str, float, float]]:
    """(rule, seconds per text, share rejected) on about ``sample_rows`` rows.

    Only the sums of each task and rule come to the driver.
    """
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))

    def run(batches: Rows) -> Rows:
        worker_memory("")
        seconds, rejected, looked = np.zeros(len(rules)), np.zeros(len(rules)), 0
        for batch in batches:
            texts = column_bytes(batch.column(0))
            m = text_metrics(texts)
            rest = np.flatnonzero(~base_failed(m))
            looked += len(rest)
            for k, rule in enumerate(rules):
                began = time.perf_counter()
                rejected[k] += sum(rule.rejects(texts[i], _row(m, i)) for i in rest)
                seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules)), pa.int32()), pa.array(seconds),
             pa.array(rejected), pa.array([float(looked)] * len(rules))],
            ["rule", "seconds", "rejected", "looked"],
        )

    sample = docs.select(F.col(f"`{text}`")).sample(False, share, seed)
    kinds = "rule int, seconds double, rejected double, looked double"
    sums = (
        map_batches(sample, run, kinds)
        .groupBy("rule")
        .agg(F.sum("seconds"), F.sum("rejected"), F.sum("looked"))
    )
    found = {row[0]: row[1:] for row in sums.collect()}
    out = []
    for k, rule in enumerate(rules):
        seconds, rejected, looked = found.get(k, (0.0, 0.0, 0.0))
        out.append((rule.name, seconds / max(looked, 1.0), rejected / max(looked, 1.0)))
    return out


def order_rules(
    rules: Sequence[Rule], measured: Sequence[tuple[str, float, float]]
) -> list[Rule]:
    """Most rejections per second first; ties keep the order given."""
    gain = {name: rejected / max(cost, 1e-9) for name, cost, rejected in measured}
    return sorted(rules, key=lambda rule: -gain[rule.name])


def judge(
    docs: DataFrame,
    text: str = "text",
    out: str = "quality",
    keep: Sequence[str] | None = None,
    rules: Sequence[Rule] = RULES,
    sample_rows: int = 2000,
) -> DataFrame:
    """``docs`` with a struct column ``out`` of the counts and the verdict;
    ``rejected_by`` names the first rule that rejected the text, or ``base``."""
    at = docs.columns.index(text)
    ordered = order_rules(rules, measure_rules(docs, text, rules, sample_rows))

    def prepare():
        def compute(batch: pa.RecordBatch):
            texts = column_bytes(batch.column(at))
            m = text_metrics(texts)
            failed = base_failed(m)
            why = np.where(failed, "base", None).astype(object)
            alive = np.flatnonzero(~failed).tolist()
            rows = {i: _row(m, i) for i in alive}
            for rule in ordered:
                passed = []
                for i in alive:
                    if rule.rejects(texts[i], rows[i]):
                        why[i] = rule.name
                    else:
                        passed.append(i)
                alive = passed
            kept = np.zeros(len(texts), bool)
            kept[alive] = True
            return [
                *[(name, pa.array(values, pa.int64())) for name, values in m.items()],
                ("base_failed", pa.array(failed)),
                ("kept", pa.array(kept)),
                ("rejected_by", pa.array(why.tolist(), pa.string())),
            ]

        return compute

    return with_result(docs, out, FIELDS, prepare, keep)

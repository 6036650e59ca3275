"""Quality of texts by a vote of their nearest labelled neighbours.

Terms are hashed words, byte pairs and words of repeated runs, counted over the whole text and weighted by
how rare they are in the whole corpus. Latent-semantic vectors come from the
leading singular vectors of a bounded sample of labelled texts. The labelled
vectors are broadcast; every document is compared to all of them by blocked matrix
products of cosines, and the labels of the nearest are weighted by similarity.

At most ``most_labelled`` labelled rows are learnt from, so what the driver and the
broadcast hold is bounded by that number times the vector's length. Term statistics
cover all documents.

Null and empty texts have no terms; they get the share of label 1 among the learnt
rows. A label that is null, or of a null id, isn't learnt from; of several labels of
an id the smallest counts. Without any labelled row all scores are 0.5. Repeated rows
get the same score. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall.llm.common import Rows, column_bytes, with_result
from emberwall.llm.words import Hasher, chunks, mix, owners, repeated_words

PAIR_TERMS = 2048
WORD_TERMS = 2048
#: Terms of words inside a repeated run of three words, dealt in turn.
REPEAT_TERMS = 32
TERMS = PAIR_TERMS + WORD_TERMS + REPEAT_TERMS
FIELDS = "score double, neighbours int"

_PAIR = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(PAIR_TERMS)).astype(np.int64)


def term_counts(texts: list[bytes], hasher: Hasher, texts_at_once: int = 512):
    """Blocks of (first text, counts per text and term)."""
    for part in chunks(texts, hasher):
        hashes = part.word_hashes()
        words = (hashes % np.uint64(WORD_TERMS)).astype(np.int64) + PAIR_TERMS
        word_at = part.word_offsets
        word_text = owners(word_at)
        again = repeated_words(hashes, word_text)
        # dealt by the place in the own text, whatever texts come before it
        again_terms = (again - word_at[word_text[again]]) % REPEAT_TERMS + PAIR_TERMS + WORD_TERMS
        data = part.data.astype(np.int64)
        pairs = _PAIR[data[:-1] * 256 + data[1:]]
        n = part.last - part.first
        for i in range(0, n, texts_at_once):
            j = min(n, i + texts_at_once)
            # the newline that ends a text begins no pair of it
            at = part.offsets[i : j + 1]
            owner = owners(at)
            inside = np.ones(len(owner), bool)
            inside[at[1:] - 1 - at[0]] = False
            inside[np.maximum(at[1:] - 2 - at[0], 0)] = False
            keys = owner * TERMS
            own_pairs = pairs[at[0] : at[-1]]
            keys[: len(own_pairs)] += own_pairs
            keys = keys[inside]
            own_words = words[word_at[i] : word_at[j]]
            word_owner = owners(word_at[i : j + 1])
            low, high = np.searchsorted(again, word_at[[i, j]])
            own_again = word_owner[again[low:high] - word_at[i]] * TERMS + again_terms[low:high]
            keys = np.concatenate([keys, word_owner * TERMS + own_words, own_again])
            counts = np.bincount(keys, minlength=(j - i) * TERMS).reshape(j - i, TERMS)
            yield part.first + i, counts


def document_frequency(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """How many documents have each term, and how many there are. The sums that
    come to the driver are one per term, whatever the data."""

    def run(batches: Rows) -> Rows:
        hasher, total, seen = Hasher(), 0, np.zeros(TERMS, np.int64)
        for batch in batches:
            for _, counts in term_counts(column_bytes(batch.column(0)), hasher):
                seen += (counts > 0).sum(axis=0)
                total += len(counts)
        at = np.flatnonzero(seen)
        terms = np.concatenate(([-1], at))
        values = np.concatenate(([total], seen[at]))
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(values)], ["term", "n"])

    rows = docs.select(text).mapInArrow(run, "term long, n long")
    found = np.zeros(TERMS + 1, np.int64)
    for term, n in rows.groupBy("term").agg(F.sum("n")).collect():
        found[term] = n
    return found[:TERMS], int(found[TERMS])


def weigh(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Dampened counts times rarity, each row of length one (or zero)."""
    rows = (np.log1p(counts) * rarity).astype(np.float32)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(norms, 1e-12)


def leading_directions(rows: np.ndarray, dims: int, seed: int = 3) -> np.ndarray:
    """About the ``dims`` leading right singular vectors, as columns, by repeated
    products with a random block."""
    dims = min(dims, *rows.shape)
    rng = np.random.default_rng(seed)
    basis = rng.standard_normal((rows.shape[1], dims + 8)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis))
    _, _, turn = np.linalg.svd(rows @ basis, full_matrices=False)
    return (basis @ turn.T[:, :dims]).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def vote(
    vectors: np.ndarray, labelled: np.ndarray, labels: np.ndarray, k: int
) -> np.ndarray:
    """The mean label of the ``k`` nearest, weighted by cosine above zero."""
    cosine = vectors @ labelled.T
    k = min(k, len(labels))
    near = np.argpartition(cosine, len(labels) - k, axis=1)[:, len(labels) - k :]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64)
    weight = weight**4
    total = weight.sum(axis=1)
    own = (weight * labels[near]).sum(axis=1)
    return np.where(total > 0, own / np.maximum(total, 1e-300), labels.mean())


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    label: str = "quality",
    id_column: str = "doc_id",
    text: str = "text",
    out: str = "vote",
    keep: Sequence[str] | None = None,
    most_labelled: int = 8192,
    dims: int = 64,
    k: int = 9,
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``score`` from 0 to 1, and from how
    many neighbours. ``learn_from`` says, on the id, whose labels may be used.

    Ids are chosen by a share of their hash that gives somewhat less than
    ``most_labelled`` of them, the most that is taken.
    """
    spark = docs.sparkSession
    eligible = (
        labels.filter(learn_from)
        .filter(F.col(label).isNotNull() & F.col(id_column).isNotNull())
        .groupBy(id_column)
        .agg(F.min(label).cast("int").alias("_label"))
        .join(docs.select(id_column).distinct(), id_column, "left_semi")
    )
    known = eligible.count()
    share = 1_000_000 if known <= most_labelled else int(950_000 * most_labelled / known)
    chosen = eligible.filter(F.pmod(F.xxhash64(id_column), F.lit(1_000_000)) < share)
    chosen = chosen.limit(most_labelled)
    seen, total = document_frequency(docs, text)
    rarity = np.log((1 + total) / (1 + seen)).astype(np.float32) + 1

    chosen_rows = chosen.collect()
    wanted = {row[0]: row[1] for row in chosen_rows}
    wanted_ids = spark.createDataFrame(
        [(i, y) for i, y in wanted.items()],
        docs.select(F.col(id_column), F.lit(0).alias("_label")).schema,
    )
    sample = docs.select(id_column, text).join(F.broadcast(wanted_ids), id_column)

    def vectorise(batches: Rows) -> Rows:
        hasher = Hasher()
        for batch in batches:
            texts = column_bytes(batch.column(1))
            for first, counts in term_counts(texts, hasher):
                at = [np.flatnonzero(row) for row in counts]
                terms = [x.astype("<u2").tobytes() for x in at]
                values = [row[x].astype("<u4").tobytes() for row, x in zip(counts, at)]
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), batch.column(2).slice(first, n),
                     pa.array(terms, pa.binary()), pa.array(values, pa.binary())],
                    ["id", "label", "terms", "counts"],
                )

    # of several texts of one id one is learnt from, the same in every run
    kind = docs.select(id_column).dtypes[0][1]
    rows = sample.mapInArrow(vectorise, f"id {kind}, label int, terms binary, counts binary")
    one = rows.groupBy("id").agg(F.min(F.struct("label", "terms", "counts")).alias("row"))
    gathered = one.orderBy("id").select("row.*").collect()
    marks = np.array([row[0] for row in gathered], np.float64)
    model = None
    if len(marks):
        counts = np.zeros((len(marks), TERMS), np.float32)
        for i, (_, terms, n) in enumerate(gathered):
            counts[i, np.frombuffer(terms, "<u2")] = np.frombuffer(n, "<u4")
        weighed = weigh(counts, rarity)
        directions = leading_directions(weighed, dims)
        model = (directions, unit(weighed @ directions), marks)
    shared = spark.sparkContext.broadcast((rarity, model))
    at = docs.columns.index(text)

    def prepare():
        rarity, model = shared.value
        hasher = Hasher()

        def compute(batch: pa.RecordBatch):
            texts = column_bytes(batch.column(at))
            score = np.full(len(texts), 0.5)
            if model is not None:
                directions, labelled, marks = model
                for first, counts in term_counts(texts, hasher):
                    vectors = unit(weigh(counts, rarity) @ directions)
                    score[first : first + len(counts)] = vote(vectors, labelled, marks, k)
            near = min(k, 0 if model is None else len(model[2]))
            return [
                ("score", pa.array(score)),
                ("neighbours", pa.array([near] * len(texts), pa.int32())),
            ]

        return compute

    return with_result(docs, out, FIELDS, prepare, keep)

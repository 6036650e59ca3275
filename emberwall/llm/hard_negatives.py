"""Hard negatives: rows of another label that are near an anchor, but not as near as its
positives.

Vectors are whole numbers (components times ``scale``, rounded down) and a row's score is
its inner product with the anchor, so all is exact. Anchors and candidates are cut into
blocks; a task multiplies one block of anchors with one block of candidates, in tiles, by
Strassen's recursion: seven products of half size instead of eight, down to small tiles,
with zeros filling up tiles that can't be halved. Additions are on 64-bit integers, which
wrap, so that sums on the way do no harm: what comes out is right if it fits 64 bits.

1. Positives: anchors meet candidates of their own label. A label with many rows is split
   over several blocks, labels with few rows share one. Each tile gives each anchor a heap
   of its best positives.
2. Negatives: anchors, with a window of scores for each positive, meet all blocks. Each
   tile gives each window a heap of its best rows.

Heaps of the same anchor or window are merged some at a time, so that no task holds more
than ``merge_at_once`` of them for one key, however many blocks there are.

Work is the number of anchors times the number of rows, as the task asks: rows travel once
per block of anchors. All rows count: nothing is sampled or left out.

Rows with a null label, a null vector, or any null or non-finite component take no part,
nor do rows with a component beyond what leaves inner products within 64 bits. Shorter
vectors are filled up with zeros, an empty one is all zeros. A repeated row is a row of
its own: a candidate of the other, and an anchor of its own. Null ids take part and come
after all others in ties; they are no anchors unless the condition holds for null. An
empty table gives an empty result. Columns besides the three are not used.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberwall.llm.common import give_back, shuffle_parts
from emberwall.session import store

#: Products with a side this short are not halved again.
SMALL = 16
#: Rows of a tile's anchors and candidates.
TILE = 128, 1024
NO_ID = 2**63 - 1
#: Blocks of candidates are not made smaller than this for the sake of more tasks.
FEW_ROWS = 4096


# --- products of tiles ------------------------------------------------------------


def padded(matrix: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """``matrix`` with zeros below and to the right, up to this size."""
    if matrix.shape == (rows, columns):
        return matrix
    out = np.zeros((rows, columns), np.int64)
    out[: matrix.shape[0], : matrix.shape[1]] = matrix
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of int64 matrices, exact modulo 2^64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= SMALL:
        return a @ b
    half_m, half_k, half_n = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = padded(a, 2 * half_m, 2 * half_k), padded(b, 2 * half_k, 2 * half_n)
    a11, a12, a21, a22 = (
        a[:half_m, :half_k], a[:half_m, half_k:], a[half_m:, :half_k], a[half_m:, half_k:],
    )
    b11, b12, b21, b22 = (
        b[:half_k, :half_n], b[:half_k, half_n:], b[half_k:, :half_n], b[half_k:, half_n:],
    )
    out = np.zeros((2 * half_m, 2 * half_n), np.int64)
    c11, c12 = out[:half_m, :half_n], out[:half_m, half_n:]
    c21, c22 = out[half_m:, :half_n], out[half_m:, half_n:]
    product = strassen(a11 + a22, b11 + b22)
    c11 += product
    c22 += product
    product = strassen(a21 + a22, b11)
    c21 += product
    c22 -= product
    product = strassen(a11, b12 - b22)
    c12 += product
    c22 += product
    product = strassen(a22, b21 - b11)
    c11 += product
    c21 += product
    product = strassen(a11 + a12, b22)
    c11 -= product
    c12 += product
    c22 += strassen(a21 - a11, b11 + b12)
    c11 += strassen(a12 - a22, b21 + b22)
    return out[:m, :n]


def tiles(anchors: np.ndarray, candidates: np.ndarray):
    """(first anchor, first candidate, scores) of all tiles."""
    for j in range(0, len(candidates), TILE[1]):
        right = candidates[j : j + TILE[1]].T
        for i in range(0, len(anchors), TILE[0]):
            yield i, j, strassen(anchors[i : i + TILE[0]], right)


# --- heaps ------------------------------------------------------------------------


def best_per_owner(owner: np.ndarray, score: np.ndarray, id_: np.ndarray, most: int):
    """Places of the ``most`` best of each owner: highest score, then smallest id."""
    order = np.lexsort((id_, -score, owner))
    ranked = owner[order]
    first = np.searchsorted(ranked, ranked)
    return order[np.arange(len(order)) - first < most]


class Heaps:
    """The ``most`` best (score, id) of each of ``n`` owners, from tile to tile."""

    def __init__(self, n: int, most: int):
        self.n, self.most = n, most
        self.owner = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)

    def add(self, owner: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        owner = np.concatenate((self.owner, owner))
        score = np.concatenate((self.score, score))
        id_ = np.concatenate((self.id, id_))
        kept = best_per_owner(owner, score, id_, self.most)
        self.owner, self.score, self.id = owner[kept], score[kept], id_[kept]

    def table(self, key: pa.Array) -> pa.Table:
        """One row (``key``, ``heap``) per owner that has met something."""
        used, first = np.unique(self.owner, return_index=True)
        offsets = np.append(first, len(self.owner)).astype(np.int32)
        entries = pa.StructArray.from_arrays(
            [pa.array(-self.score), pa.array(self.id)], ["minus", "id"]
        )
        heaps = pa.ListArray.from_arrays(pa.array(offsets), entries)
        return pa.Table.from_arrays([key.take(pa.array(used)), heaps], ["key", "heap"])


HEAP = "array<struct<minus: long, id: long>>"


def merged(heaps: DataFrame, most: int, at_once: int, parts: int) -> DataFrame:
    """One heap per ``key``, of heaps (``key``, ``part``, ``heap``) with parts 0 to
    ``parts`` - 1: those of neighbouring parts first, until one is left."""
    best = F.slice(F.array_sort(F.flatten(F.collect_list("heap"))), 1, most).alias("heap")
    while parts > at_once:
        parts = -(-parts // at_once)
        part = F.floor(F.col("part") / at_once).cast("long").alias("part")
        heaps = heaps.groupBy("key", part).agg(best)
    return heaps.groupBy("key").agg(best)


# --- blocks in Spark --------------------------------------------------------------


def matrix_of(column, dims: int) -> np.ndarray:
    """Binary values of ``dims`` little-endian 64-bit integers as rows."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<i8").reshape(-1, dims)


def usable(
    df: DataFrame, id_column: str, label: Column, vector: str, scale: int
) -> tuple[DataFrame, int]:
    """(``row``, ``id``, ``label``, ``v``) of the rows that take part, stored, and the
    longest vector. ``row`` tells repeated rows apart."""
    value = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        label.cast("long").alias("label"),
        value.alias("v"),
    ).filter(
        F.col("label").isNotNull()
        & F.col("v").isNotNull()
        & F.coalesce(F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < math.inf)), F.lit(False))
    )
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    # The largest inner product of two rows has to be a 64-bit number.
    most = math.isqrt((2**63 - 1) // max(1, longest)) - 1
    scaled = F.transform("v", lambda x: F.floor(x * scale))
    rows = rows.filter(F.forall("v", lambda x: F.abs(x * scale) <= most)).select(
        F.monotonically_increasing_id().alias("row"), "id", "label", scaled.alias("v")
    )
    return store(rows, "whole_vectors"), longest


def packed(rows: DataFrame, dims: int) -> DataFrame:
    """``v`` as bytes of ``dims`` numbers, zeros after its own."""
    at = rows.columns.index("v")
    names = rows.columns
    kind = [(f.name, "binary" if f.name == "v" else f.dataType.simpleString()) for f in rows.schema]

    def run(batches):
        for batch in batches:
            lists = batch.column(at)
            sizes = np.diff(lists.offsets.to_numpy())
            matrix = np.zeros((len(sizes), dims), "<i8")
            matrix[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            columns = list(batch.columns)
            columns[at] = pa.array([x.tobytes() for x in matrix], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, ", ".join(f"{name} {type_}" for name, type_ in kind))


def _salt(n: Column) -> Column:
    return F.pmod(F.xxhash64("row"), n)


def _every(n: Column) -> Column:
    """All numbers below ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))


def _blocks(n: Column, size: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("long")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label: Column | str = "label",
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block_bytes: int = 16 << 20,
    anchor_bytes: int = 4 << 20,
    merge_at_once: int = 256,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``). Anchors are the rows for whose id the condition ``is_anchor``
    holds; their positives are the ``positives`` best other rows of their label; for each
    of these the ``negatives`` best rows of other labels are given whose score is ``low`` to
    ``high`` per cent of the positive's, both included. Ties go to the smaller id."""
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    rows, dims = usable(vectors, id_column, label, vector, scale)
    dims = max(1, dims)
    total = rows.count()
    block_rows, anchors_at_once = (max(1, x // (8 * dims)) for x in (block_bytes, anchor_bytes))
    # Blocks of a small table are smaller, so that all cores have some.
    block_rows = min(block_rows, max(FEW_ROWS, -(-total // shuffle_parts(vectors))))
    rows = store(packed(rows, dims), "packed_vectors")
    whole = f"_{id_column}"
    asked = rows.select(F.col("id").alias(id_column), F.struct(*rows.columns).alias(whole))
    anchors = store(asked.filter(is_anchor).select(f"`{whole}`.*"), "anchors")

    # Labels by how many blocks of candidates and of anchors they need; there may be as
    # many labels as rows, so the list is joined, never gathered. Labels that fill no
    # block share one of ``shared``.
    shared = max(1, -(-total // block_rows))
    in_all = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    asked = anchors.groupBy("label").agg(F.count(F.lit(1)).alias("n_anchors"))
    labels = store(
        in_all.join(asked, "label").select(
            "label",
            (F.col("n") > block_rows).alias("large"),
            _blocks(F.col("n"), block_rows).alias("parts"),
            _blocks(F.col("n_anchors"), anchors_at_once).alias("blocks"),
        ),
        "labels",
    )

    def place(part: Column) -> Column:
        alone = F.xxhash64("label", part.cast("long"))
        return F.when(F.col("large"), alone).otherwise(F.pmod(F.xxhash64("label"), F.lit(shared)))

    own = rows.join(labels, "label")
    met = own.withColumn("place", place(_salt(F.col("parts")))).withColumn(
        "block", F.when(F.col("large"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    # Anchors of labels with few rows are few in any one place: they make one block.
    met = met.withColumn("block", F.explode(F.coalesce("block", F.array(F.lit(0).cast("long")))))
    asking = anchors.join(labels, "label").withColumn("part", _every(F.col("parts")))
    asking = asking.withColumn("place", place(F.col("part"))).withColumn(
        "block", F.when(F.col("large"), _salt(F.col("blocks"))).otherwise(F.lit(0).cast("long"))
    )
    same = _positives(positives, dims)
    columns = ["place", "block", "row", "id", "label", "v"]
    found = (
        asking.select(*columns, "part")
        .groupBy("place", "block")
        .cogroup(met.select(*columns).groupBy("place", "block"))
        .applyInArrow(same, f"key long, part long, heap {HEAP}")
    )
    # a label has at most so many parts
    near = merged(found, positives, merge_at_once, shared)
    windows = F.transform(
        "heap",
        lambda e: F.struct(
            e["id"].alias("id"),
            (-e["minus"]).alias("score"),
            # least and greatest whole number within the percentages
            F.ceil(-e["minus"] * F.lit(low).cast("decimal(4,0)") / 100).cast("long").alias("low"),
            F.floor(-e["minus"] * F.lit(high).cast("decimal(4,0)") / 100).cast("long").alias("high"),
        ),
    )
    wanted = store(
        anchors.join(near.withColumnRenamed("key", "row"), "row").select(
            "row", "id", "label", "v", windows.alias("windows")
        ),
        "windows",
    )

    blocks = max(1, -(-wanted.count() // anchors_at_once))
    left = wanted.withColumn("block", _salt(F.lit(blocks))).withColumn(
        "place", _every(F.lit(shared).cast("long"))
    )
    right = rows.withColumn("place", _salt(F.lit(shared))).withColumn(
        "block", _every(F.lit(blocks).cast("long"))
    )
    found = (
        left.select(*columns, "windows")
        .groupBy("place", "block")
        .cogroup(right.select(*columns).groupBy("place", "block"))
        .applyInArrow(
            _negatives(negatives, dims), f"key struct<row: long, at: int>, part long, heap {HEAP}"
        )
    )
    heaps = merged(found, negatives, merge_at_once, shared)

    def shown(id_: Column) -> Column:
        return F.when(id_ != NO_ID, id_)

    one = F.get(F.col("windows"), F.col("key.at"))
    known = wanted.select("row", F.col("id").alias("anchor_id"), "windows")
    return (
        heaps.withColumn("row", F.col("key.row"))
        .join(known, "row")
        .select(
            "anchor_id",
            one.alias("positive"),
            F.posexplode("heap").alias("at", "negative"),
        )
        .select(
            "anchor_id",
            shown(F.col("positive.id")).alias("positive_id"),
            (F.col("at") + 1).cast("int").alias("rank"),
            shown(F.col("negative.id")).alias("negative_id"),
            F.col("positive.score").alias("positive_score"),
            (-F.col("negative.minus")).alias("negative_score"),
        )
    )


def _ids(column) -> np.ndarray:
    return column.combine_chunks().fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _numbers(column) -> np.ndarray:
    return column.to_numpy()


def _positives(most: int, dims: int):
    """Of a block of anchors and one of candidates, each anchor's heap of its label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        heaps = Heaps(left.num_rows, most)
        if left.num_rows and right.num_rows:
            rows, labels = _numbers(left.column("row")), _numbers(left.column("label"))
            others, other_labels = _numbers(right.column("row")), _numbers(right.column("label"))
            ids = _ids(right.column("id"))
            a, b = matrix_of(left.column("v"), dims), matrix_of(right.column("v"), dims)
            for i, j, scores in tiles(a, b):
                there = slice(i, i + len(scores)), slice(j, j + scores.shape[1])
                fits = (labels[there[0], None] == other_labels[None, there[1]]) & (
                    rows[there[0], None] != others[None, there[1]]
                )
                if scores.shape[1] > most:  # what can't be among the best of this tile goes
                    known = np.where(fits, scores, np.iinfo(np.int64).min)
                    fits &= scores >= -np.partition(-known - 1, most - 1)[:, most - 1 : most] - 1
                at, of = np.nonzero(fits)
                heaps.add(at + i, scores[at, of], ids[of + j])
            del a, b
        table = heaps.table(left.column("row").combine_chunks())
        parts = left.column("part").take(pa.array(np.unique(heaps.owner)))
        give_back()
        return pa.Table.from_arrays(
            [table.column("key"), parts, table.column("heap")], ["key", "part", "heap"]
        )

    return run


def _negatives(most: int, dims: int):
    """Of a block of anchors and one of candidates, the heap of each anchor's windows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        windows = left.column("windows").combine_chunks()
        counts = np.diff(windows.offsets.to_numpy()) if left.num_rows else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(left.num_rows), counts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        flat = windows.flatten()
        low, high = (flat.field(x).to_numpy(zero_copy_only=False) for x in ("low", "high"))
        heaps = Heaps(len(owner), most)
        if len(owner) and right.num_rows:
            labels = _numbers(left.column("label"))
            other_labels, ids = _numbers(right.column("label")), _ids(right.column("id"))
            a, b = matrix_of(left.column("v"), dims), matrix_of(right.column("v"), dims)
            # scores below all windows of an anchor are of no use
            floor = np.full(left.num_rows, NO_ID)
            np.minimum.at(floor, owner, np.where(low <= high, low, NO_ID))
            first = np.searchsorted(owner, np.arange(left.num_rows + 1))
            for i, j, scores in tiles(a, b):
                there = slice(i, i + len(scores)), slice(j, j + scores.shape[1])
                near = (scores >= floor[there[0], None]) & (
                    labels[there[0], None] != other_labels[None, there[1]]
                )
                at, of = np.nonzero(near)
                score, id_ = scores[at, of], ids[of + j]
                # best first for each anchor: a window's rows then follow one another
                order = np.lexsort((id_, -score, at))
                at, score, id_ = at[order], score[order], id_[order]
                edges = np.searchsorted(at, np.arange(len(scores) + 1))
                taken, windows_of = [], []
                for k in range(len(scores)):
                    minus = -score[edges[k] : edges[k + 1]]
                    if not len(minus):
                        continue
                    own = slice(first[i + k], first[i + k + 1])
                    begin = np.searchsorted(minus, -high[own], side="left")
                    end = np.searchsorted(minus, -low[own], side="right")
                    for w in range(len(begin)):
                        places = np.arange(begin[w], min(end[w], begin[w] + most))
                        taken.append(places + edges[k])
                        windows_of.append(np.full(len(places), own.start + w))
                if taken:
                    places = np.concatenate(taken)
                    heaps.add(np.concatenate(windows_of), score[places], id_[places])
            del a, b
        keys = pa.StructArray.from_arrays(
            [
                left.column("row").combine_chunks().take(pa.array(owner)),
                pa.array(number, pa.int32()),
            ],
            ["row", "at"],
        )
        table = heaps.table(keys)
        place = left.column("place")[0].as_py() if left.num_rows else 0
        parts = pa.array([place] * table.num_rows, pa.int64())
        give_back()
        return pa.Table.from_arrays(
            [table.column("key"), parts, table.column("heap")], ["key", "part", "heap"]
        )

    return run

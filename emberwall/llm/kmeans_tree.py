"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

The tree is fitted on a bounded sample: every node splits its rows by k-means, down
to the leaves. All rows are put into leaves. A query goes through the tree best bin
first: a priority queue holds nodes by the inner product with their centre, the best
is taken, an inner node gives its children, a leaf is visited. How many leaves are
visited is calibrated: on queries from the sample, visits widen until the share of
their true neighbours found reaches ``recall``. A query visits more than that until
its leaves hold ``k`` candidates, so it gets fewer only if there are fewer.

The tree is broadcast; it has at most ``most_leaves`` leaves, whatever the data. A
leaf with many rows is split into bins of bounded size, bins are gathered into shards,
and queries go in blocks to the shards with bins they visit, so that no task holds
more than a shard and a block. Scores are recomputed in double precision on the
original vectors.

Vectors that are null, zero, or hold null or non-finite components take no part, nor
do null ids and vectors of another length than the most common one (ties: the
shortest). Rows with the same id are candidates each; as a query such an id is asked
once, with its smallest vector. Equal scores are ordered by id. An empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberwall.llm.common import Rows, shuffle_parts
from emberwall.session import store


def list_matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def kmeans(rows: np.ndarray, k: int, rng, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Centres and the number of each row's centre."""
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)]
    for _ in range(rounds):
        near = nearest(rows, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        filled = counts > 0
        centres = np.where(filled[:, None], sums / np.maximum(counts, 1)[:, None], centres)
    near = nearest(rows, centres)
    used, near = np.unique(near, return_inverse=True)
    return centres[used], near


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * rows @ centres.T, axis=1)


@dataclass
class Tree:
    """Node 0 is the root; ``leaf`` is the leaf's number or -1."""

    centres: np.ndarray
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    @staticmethod
    def fit(rows: np.ndarray, branching: int, leaf_rows: float, seed: int = 7) -> Tree:
        """Split nodes of more than ``leaf_rows`` rows."""
        rng = np.random.default_rng(seed)
        tree = Tree(np.zeros((0, rows.shape[1])))
        centres = [rows.mean(axis=0)]
        tree.children.append([])
        tree.leaf.append(-1)
        todo = [(0, rows)]
        while todo:
            node, own = todo.pop()
            if len(own) > leaf_rows:
                k = int(min(branching, max(2, np.ceil(len(own) / leaf_rows))))
                middles, near = kmeans(own, k, rng)
                if len(middles) > 1:
                    for i, middle in enumerate(middles):
                        child = len(centres)
                        centres.append(middle)
                        tree.children.append([])
                        tree.leaf.append(-1)
                        tree.children[node].append(child)
                        todo.append((child, own[near == i]))
                    continue
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
        tree.centres = np.array(centres)
        return tree

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row: down to the nearest centre at every node."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            if not len(own):
                continue
            if self.leaf[node] >= 0:
                out[own] = self.leaf[node]
                continue
            below = self.children[node]
            near = nearest(rows[own], self.centres[below])
            todo += [(child, own[near == i]) for i, child in enumerate(below)]
        return out

    def visits(
        self, scores: np.ndarray, most: int, held: dict[int, int] | None = None, rows: int = 0
    ) -> list[int]:
        """The ``most`` first leaves, best bin first, by the scores of all nodes, and
        further ones until they hold ``rows`` rows, by the rows ``held`` per leaf."""
        queue, out, met = [(-float(scores[0]), 0)], [], 0
        while queue and (len(out) < most or met < rows):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                out.append(self.leaf[node])
                met += held.get(self.leaf[node], 0) if held else 0
            for child in self.children[node]:
                heapq.heappush(queue, (-float(scores[child]), child))
        return out

    def calibrate(self, rows: np.ndarray, k: int, recall: float, asked: int) -> int:
        """How many leaves to visit so that queries from ``rows`` find the share
        ``recall`` of their ``k`` nearest among ``rows``."""
        leaf_of = self.assign(rows)
        k = min(k, len(rows) - 1)
        if k < 1:
            return self.leaves
        every = max(1, len(rows) // asked)
        needed = []
        for i in range(0, len(rows), every):
            score = rows @ rows[i]
            score[i] = -np.inf
            near = np.argpartition(score, len(rows) - k)[len(rows) - k :]
            order = np.empty(self.leaves, np.int64)
            order[self.visits(self.centres @ rows[i], self.leaves)] = np.arange(self.leaves)
            needed.append(order[leaf_of[near]] + 1)
        needed = np.sort(np.concatenate(needed))
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])


def usable(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(``id``, ``v``) of the rows that take part."""
    value = F.col(f"`{vector}`").cast("array<double>")
    infinite = F.lit(float("inf"))
    finite = F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    )
    rows = df.select(F.col(f"`{id_column}`").alias("id"), value.alias("v")).filter(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.coalesce(finite, F.lit(False))
    )
    rows = rows.filter(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n")
    first = sizes.first()
    return rows.filter(F.size("v") == (first["n"] if first else 0))


def top(scores: np.ndarray, rows: np.ndarray, query: np.ndarray, ids: np.ndarray, k: int):
    """Ids and exact scores of the ``k`` best of ``rows``, by rough scores."""
    found = np.flatnonzero(scores > -np.inf)
    if len(found) > k:
        edge = np.partition(scores[found], len(found) - k)[len(found) - k]
        slack = 1e-9 * (1 + abs(edge))  # ties must not depend on rounding
        found = found[scores[found] >= edge - slack]
    exact = (rows[found] * query).sum(axis=1)
    order = np.lexsort((ids[found], -exact))[:k]
    return ids[found][order], exact[order]


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    recall: float = 0.95,
    sample_rows: int = 8192,
    branching: int = 12,
    leaf_rows: int = 256,
    most_leaves: int = 4096,
    shard_rows: int = 32768,
    queries_at_once: int = 16384,
    asked: int = 256,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): the ``k`` best candidates found
    for each row of ``vectors`` that ``is_query``, a condition on the id, holds for,
    itself left out."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_column].dataType
    result = T.StructType(
        [T.StructField("query_id", kind), T.StructField("rank", T.IntegerType()),
         T.StructField("vec_id", kind), T.StructField("score", T.DoubleType())]
    )
    rows = usable(vectors, id_column, vector)
    total = rows.count()
    if not total:
        return spark.createDataFrame([], result)
    share = min(1.0, sample_rows / total)
    gathered = rows.select("v").sample(False, share, 7).toArrow()
    if not gathered.num_rows:
        gathered = rows.select("v").limit(1).toArrow()
    sample = list_matrix(gathered.column(0))
    leaves = min(most_leaves, max(1, total // leaf_rows), max(1, len(sample) // 16))
    tree = Tree.fit(sample, branching, len(sample) / leaves)
    visits = tree.calibrate(sample, k, recall, asked)
    # plain values, as broadcasts are read where this class need not be installed
    shared = spark.sparkContext.broadcast((tree.centres, tree.children, tree.leaf, tree.leaves))

    def assign(batches: Rows) -> Rows:
        tree = Tree(*shared.value)
        for batch in batches:
            leaf = tree.assign(list_matrix(batch.column(1))) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf, pa.int64())], ["id", "v", "leaf"]
            )

    rows_kind = T.StructType([*rows.schema.fields, T.StructField("leaf", T.LongType())])
    placed = store(rows.mapInArrow(assign, rows_kind), "leaves")

    # Bins of bounded size, gathered into shards in the order of the leaves.
    counts = dict(placed.groupBy("leaf").count().collect())
    per_shard = max(1, min(shard_rows, -(-total // shuffle_parts(vectors))))
    first_bin, bins, shard_of, filled, shard = {}, {}, [], 0, 0
    for leaf in sorted(counts):
        n = -(-counts[leaf] // per_shard)
        first_bin[leaf], bins[leaf] = len(shard_of), n
        for _ in range(n):
            if filled and filled + counts[leaf] // n > per_shard:
                shard, filled = shard + 1, 0
            shard_of.append(shard)
            filled += counts[leaf] // n
    shards_of = {
        leaf: sorted(set(shard_of[first_bin[leaf] : first_bin[leaf] + bins[leaf]]))
        for leaf in counts
    }
    layout = spark.createDataFrame(
        [(leaf, bins[leaf], [shard_of[first_bin[leaf] + i] for i in range(bins[leaf])])
         for leaf in counts],
        "leaf long, bins int, shards array<int>",
    )
    at = F.pmod(F.xxhash64("id", "v"), F.col("bins")).cast("int")
    binned = placed.join(F.broadcast(layout), "leaf").select(
        "id", "v", "leaf", F.get("shards", at).alias("shard")
    )

    # Queries, each once, with the leaves they visit in each shard.
    asked_rows = (
        placed.withColumnRenamed("id", id_column)
        .filter(is_query)
        .groupBy(F.col(id_column).alias("id"))
        .agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own"))
    )
    blocks = max(1, -(-asked_rows.count() // queries_at_once))
    asked_rows = asked_rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    where = spark.sparkContext.broadcast((shards_of, counts))

    asked_names = asked_rows.columns

    def travel(batches: Rows) -> Rows:
        tree, (shards, held) = Tree(*shared.value), where.value
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = list_matrix(batch.column(1)) @ tree.centres.T
            owner, shard, visited = [], [], []
            for i, (own, copies) in enumerate(zip(scores, batch.column(2).to_pylist())):
                meets: dict[int, list[int]] = {}
                # rows with the query's id are no candidates
                for leaf in tree.visits(own, visits, held, k + copies):
                    for s in shards.get(leaf, ()):
                        meets.setdefault(s, []).append(leaf)
                owner += [i] * len(meets)
                shard += meets.keys()
                visited += meets.values()
            taken = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [c.take(taken) for c in batch.columns]
                + [pa.array(shard, pa.int32()), pa.array(visited, pa.list_(pa.int64()))],
                [*asked_names, "shard", "visited"],
            )

    travel_kind = T.StructType(
        [*asked_rows.schema.fields, T.StructField("shard", T.IntegerType()),
         T.StructField("visited", T.ArrayType(T.LongType()))]
    )
    sent = asked_rows.mapInArrow(travel, travel_kind)

    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    copies = binned.withColumn("block", every_block)

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("id").to_numpy()
        matrix = list_matrix(left.column("v"))
        leaf = left.column("leaf").to_numpy()
        query_ids = right.column("id").to_numpy()
        asked = list_matrix(right.column("v"))
        visited = right.column("visited").to_pylist()
        best_ids, best_scores = [], []
        known = np.unique(leaf)
        at = np.searchsorted(known, leaf)
        for i in range(0, len(asked) if len(matrix) else 0, 128):
            rough = asked[i : i + 128] @ matrix.T
            for q, scores in enumerate(rough, start=i):
                seen = np.isin(known, visited[q])
                scores[~seen[at] | (ids == query_ids[q])] = -np.inf
                near, exact = top(scores, matrix, asked[q], ids, k)
                best_ids.append(near)
                best_scores.append(exact)
        n = len(best_ids)
        return pa.Table.from_arrays(
            [right.column("id").slice(0, n),
             pa.array(best_ids, pa.list_(left.schema.field("id").type)),
             pa.array(best_scores, pa.list_(pa.float64()))],
            ["query_id", "ids", "scores"],
        )

    found_kind = T.StructType(
        [T.StructField("query_id", kind), T.StructField("ids", T.ArrayType(kind)),
         T.StructField("scores", T.ArrayType(T.DoubleType()))]
    )
    found = (
        copies.groupBy("shard", "block")
        .cogroup(sent.groupBy("shard", "block"))
        .applyInArrow(compare, found_kind)
    )
    pairs = F.transform(
        F.arrays_zip("scores", "ids"),
        lambda x: F.struct((-x["scores"]).alias("minus"), x["ids"].alias("id")),
    )
    merged = found.groupBy("query_id").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list(pairs))), 1, k).alias("best")
    )
    return merged.select("query_id", F.posexplode("best").alias("at", "one")).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("one.id").alias("vec_id"),
        (-F.col("one.minus")).alias("score"),
    )

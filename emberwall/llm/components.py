"""Connected components of links, as Spark jobs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberwall.session import store


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A few links that connect what the links ``a``-``b`` connect: every node but
    the smallest of its component, linked to that smallest one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _signature(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))
    ).first()
    return tuple(row)



def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(``node``, ``root``) of every node with a link, from links (``a``, ``b``) of
    long numbers; the root is the smallest node of its component.

    Alternates two steps until nothing changes: link the larger neighbours of a
    node to the smallest one, then the smaller neighbours. The rounds grow with
    the logarithm of the nodes. Each round is stored in the shared folder. The
    smallest neighbour is found by a sum that is combined before the shuffle and
    joined back, so a node with very many neighbours is split by the join.
    """
    links = (
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        .filter("high <> low")
        .distinct()
    )
    links = store(links, "links")
    before = _signature(links)
    for _ in range(most_rounds):
        both = links.select(F.col("high").alias("node"), F.col("low").alias("other"))
        both = both.unionByName(
            links.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        least = both.groupBy("node").agg(F.min(F.least("node", "other")).alias("least"))
        large = (
            both.filter("other > node")
            .join(least, "node")
            .select(F.col("other").alias("high"), F.col("least").alias("low"))
            .filter("high <> low")
            .distinct()
        )
        least = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
        small = large.join(least, large["high"] == least["node"]).select(
            F.inline(
                F.array(
                    F.struct(F.col("low").alias("high"), F.col("least").alias("low")),
                    F.struct(F.col("high"), F.col("least").alias("low")),
                )
            )
        )
        links = store(small.filter("high <> low").distinct(), "links")
        after = _signature(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"links did not settle in {most_rounds} rounds")
    roots = links.groupBy(F.col("low").alias("node")).agg(F.min("low").alias("root"))
    members = links.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return members.unionByName(roots)

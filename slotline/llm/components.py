"""Connected components of a graph of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotline.llm.common import shared


def star_forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as ``u``-``v``, at most one per node: (node, its root).

    Roots' indices fall to the smallest in reach, then to their roots' roots,
    until nothing changes; all links at once.
    """
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b):
            np.minimum.at(new, root[end], low)
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def components(links: DataFrame, *, most_rounds: int = 40) -> DataFrame:
    """``links`` (u, v) to (node, root): the smallest node reachable from each linked node.

    Alternating large-star and small-star steps, which need a number of rounds
    that grows with the logarithm of the longest path. Each round is two
    aggregated joins and is written to the shared folder, so no lineage grows
    and no executor's loss costs more than a round. Roots themselves and nodes
    without links to others are left out. No links give an empty result.
    """
    edges = shared(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = shared(small)
        seen = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if seen == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
    raise RuntimeError("the components did not settle")

"""Connected components of an edge table by alternating stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): large
stars hang a node's larger neighbours on its smallest one, small stars its
smaller ones, until nothing changes, in few rounds whatever the graph. Edges
are first reduced to a forest within each task. Every round is written to the
shared folder; only a row count and a checksum reach the driver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.llm.common import written

FOREST_EDGES = 1 << 18  #: edges that a task reduces at once


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each one's component) of the edges a - b."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while True:
            jump = root[root]
            if (jump == root).all():
                break
            root = jump
        if (root == before).all():
            return nodes, nodes[root]


def _forest(batches):
    held = []

    def reduced():
        a, b = (np.concatenate(x) for x in zip(*held, strict=True))
        nodes, root = roots(a, b)
        return nodes[nodes != root], root[nodes != root]

    for pdf in batches:
        held.append((pdf.u.to_numpy(), pdf.v.to_numpy()))
        if sum(len(x) for x, _ in held) > FOREST_EDGES:
            u, v = reduced()
            held = [(u, v)]
            if len(u) > FOREST_EDGES // 2:
                yield pd.DataFrame({"u": u, "v": v})
                held = []
    if held:
        u, v = reduced()
        yield pd.DataFrame({"u": u, "v": v})


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    hung = joined.where(F.col("v") > F.col("u")) if large else joined.where(F.col("v") != F.col("m"))
    out = hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with an edge (u, v: long); the root is the component's smallest node."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
                  .mapInPandas(_forest, "u long, v long"), "edges")
    mark = None
    while True:
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        # in a star forest every node hangs on its root alone: one more round changes nothing
        if new == mark or new[0] == 0:
            break
        mark = new
        now = written(_star(_star(now, True), False), "edges")
    hung = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return hung.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())

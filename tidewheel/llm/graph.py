"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import release, staged


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung below the smallest node it sees."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung below the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (u, v) reaches.

    Nodes are longs; nodes without an edge do not appear, and edges with a null end say
    nothing. Rounds run until nothing changes, about the logarithm of the longest path.
    Every round is written to the shared folder, and the one before it removed. A hub costs as many rows as it has neighbours; both joins are
    plain equi-joins, whose large partitions adaptive execution splits.
    """
    current = staged(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        last, current = current, staged(small_star(large_star(current)), "edges")
        release(last)
    nodes = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.union(roots)


def stars(links: np.ndarray) -> np.ndarray:
    """Star edges (node, root) with the same components as a small adjacency matrix."""
    size = len(links)
    root = np.arange(size)
    while True:
        seen = np.where(links, root[None, :], size).min(1)
        lower = np.minimum(root, seen)
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    moved = np.flatnonzero(root != np.arange(size))
    return np.stack([moved, root[moved]], 1)

"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors whose cosine is at least c lie within epsilon = sqrt(2 - 2c). They are
sorted by the grid cells, epsilon wide, of their leading principal coordinates.
The sorted sequence is cut into intervals, and these into blocks. Of a pair of intervals
whose boxes are not provably farther apart than epsilon only those blocks are sent to
a task that are near to a block of the other interval; they are joined, recursively by
halves, down to pieces that are compared with one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import staged
from tidewheel.llm.graph import components, stars
from tidewheel.llm.topk import matrix, usable

LEADING = 8
INTERVAL = 8192
"""Vectors of a sequence interval: what a task holds twice at most."""
LEAF = 512
"""Vectors of a block, and of a piece that is compared as a whole."""


def principal(table: DataFrame, width: int) -> np.ndarray:
    """The leading principal directions, from sums that Spark adds up per cell."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width))
        for frame in frames:
            if len(frame):
                x = matrix(frame["v"], width)
                total += np.vstack([x.T @ x, x.sum(0)])
        yield pd.DataFrame({"cell": np.arange(total.size), "x": total.ravel()})

    added = table.select("v").mapInPandas(sums, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    total = np.zeros((width + 1) * width)
    for row in added.collect():
        total[row["cell"]] = row["x"]
    total = total.reshape(width + 1, width)
    n = max(table.count(), 1)
    mean = total[-1] / n
    _, vectors = np.linalg.eigh(total[:-1] / n - np.outer(mean, mean))
    return np.ascontiguousarray(vectors[:, ::-1][:, :LEADING])


def in_order(table: DataFrame, basis: np.ndarray, epsilon: float) -> DataFrame:
    """``table`` with leading coordinates ``p`` and the number of its interval in the
    grid order. Positions are offsets of range partitions plus places within them."""
    width, lead = basis.shape

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                p = matrix(frame["v"], width) @ basis
                yield frame.assign(p=list(p), cells=list(np.floor(p / epsilon).astype(np.int32)))

    cells = [F.col("cells")[i] for i in range(lead)]
    laid = table.mapInPandas(project, "id long, copies long, v binary, p array<double>, cells array<int>")
    laid = laid.repartitionByRange(*cells, "id").sortWithinPartitions(*cells, "id")
    laid = staged(laid.withColumn("at", F.monotonically_increasing_id()), "grid")
    laid = laid.withColumn("range", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1))
    counts = laid.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = laid.join(F.broadcast(offsets), "range")  # one row per partition
    place = F.col("offset") + F.col("at")
    return placed.select(
        "id",
        "copies",
        "v",
        "p",
        F.col("cells")[0].alias("cell"),
        place.alias("place"),
        F.floor(place / INTERVAL).cast("long").alias("interval"),
        F.floor(place / LEAF).cast("long").alias("block"),
    )


def interval_pairs(laid: DataFrame, lead: int, epsilon: float) -> DataFrame:
    """Pairs (i, j), i <= j, of intervals whose boxes come within epsilon. They meet in
    an equi-join on the first cell, which intervals in grid order cover few of."""
    box = laid.groupBy("interval").agg(
        F.min("cell").alias("first"),
        F.max("cell").alias("last"),
        F.array(*(F.min(F.col("p")[i]) for i in range(lead))).alias("low"),
        F.array(*(F.max(F.col("p")[i]) for i in range(lead))).alias("high"),
    )
    home = box.select(F.col("interval").alias("i"), F.col("low").alias("low_i"), F.col("high").alias("high_i"),
                      F.explode(F.sequence("first", "last")).alias("cell"))
    near = box.select(F.col("interval").alias("j"), F.col("low").alias("low_j"), F.col("high").alias("high_j"),
                      F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    gap = F.expr(
        "aggregate(sequence(0, size(low_i) - 1), 0D, (a, k) ->"
        " a + pow(greatest(0D, low_i[k] - high_j[k], low_j[k] - high_i[k]), 2))"
    )
    met = home.join(near, "cell").where((F.col("i") <= F.col("j")) & (gap <= epsilon**2 * (1 + 1e-9)))
    return met.select("i", "j").distinct()


def near_blocks(laid: DataFrame, pairs: DataFrame, lead: int, epsilon: float) -> DataFrame:
    """(i, j, right, block): the blocks of either interval of a pair that come within epsilon of
    a block of the other one. An interval has about ``INTERVAL / LEAF`` blocks."""
    box = laid.groupBy("interval", "block").agg(
        F.array(*(F.min(F.col("p")[i]) for i in range(lead))).alias("low"),
        F.array(*(F.max(F.col("p")[i]) for i in range(lead))).alias("high"),
    )
    boxes = box.groupBy("interval").agg(F.collect_list(F.struct("block", "low", "high")).alias("boxes"))
    both = pairs.join(boxes.select(F.col("interval").alias("i"), F.col("boxes").alias("a")), "i").join(
        boxes.select(F.col("interval").alias("j"), F.col("boxes").alias("b")), "j"
    )
    near = (
        f"aggregate(sequence(0, {lead - 1}), 0D, (s, k) -> s + pow(greatest(0D, x.low[k] - y.high[k], y.low[k] - x.high[k]), 2))"
        f" <= {epsilon**2 * (1 + 1e-9)!r}D"
    )
    left = F.expr(f"transform(filter(a, x -> exists(b, y -> {near})), x -> struct(false AS right, x.block AS block))")
    right = F.expr(f"transform(filter(b, x -> exists(a, y -> {near})), x -> struct(true AS right, x.block AS block))")
    sides = F.when(F.col("i") == F.col("j"), left).otherwise(F.concat(left, right))
    return both.select("i", "j", F.inline(sides))


def join_sequences(left: dict, right: dict, cosine: float, epsilon: float, same: bool):
    """Link counts of both sides, weighted by copies, and edges that span the links.

    Halves recursively; a pair of blocks is skipped if their boxes in the leading
    coordinates are farther apart than epsilon. ``same``: both are one interval.
    """
    counts = [np.zeros(len(left["id"]), np.int64), np.zeros(len(right["id"]), np.int64)]
    edges: list[np.ndarray] = []

    def box(side: dict, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        return side["p"][a:b].min(0), side["p"][a:b].max(0)

    def leaf(a: int, b: int, c: int, d: int) -> None:
        close = left["f"][a:b] @ right["f"][c:d].T >= cosine - 1e-4
        if same:
            close &= np.arange(a, b)[:, None] < np.arange(c, d)[None, :]
        i, j = np.nonzero(close)
        if not len(i):
            return
        exact = np.einsum("ij,ij->i", left["v"][a + i], right["v"][c + j])
        exact /= left["n"][a + i] * right["n"][c + j]
        i, j = i[exact >= cosine], j[exact >= cosine]
        if not len(i):
            return
        np.add.at(counts[0], a + i, right["copies"][c + j])
        np.add.at(counts[0] if same else counts[1], c + j, left["copies"][a + i])
        nodes = np.unique(np.concatenate([left["id"][a + i], right["id"][c + j]]))
        x, y = np.searchsorted(nodes, left["id"][a + i]), np.searchsorted(nodes, right["id"][c + j])
        links = np.zeros((len(nodes), len(nodes)), bool)
        links[x, y] = links[y, x] = True
        edges.append(nodes[stars(links)])

    todo = [(0, len(left["id"]), 0, len(right["id"]))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or (same and d <= a):
            continue
        (low, high), (low2, high2) = box(left, a, b), box(right, c, d)
        gap = np.maximum(np.maximum(low - high2, low2 - high), 0)
        if (gap * gap).sum() > epsilon**2 * (1 + 1e-9):
            continue
        if b - a <= LEAF and d - c <= LEAF:
            leaf(a, b, c, d)
            continue
        rows = [(a, b)] if b - a <= LEAF else [(a, (a + b) // 2), ((a + b) // 2, b)]
        cols = [(c, d)] if d - c <= LEAF else [(c, (c + d) // 2), ((c + d) // 2, d)]
        todo.extend((*r, *s) for r in rows for s in cols)
    return counts, np.unique(np.concatenate(edges), axis=0) if edges else np.zeros((0, 2), np.int64)


def links(laid: DataFrame, pairs: DataFrame, width: int, lead: int, cosine: float, epsilon: float) -> DataFrame:
    """Rows (id, n, other): link counts with null ``other``, and edges with null ``n``."""

    def side(frame: pd.DataFrame) -> dict:
        v = matrix(frame["v"], width)
        norm = np.sqrt((v * v).sum(1))
        return {
            "id": frame["id"].to_numpy(),
            "copies": frame["copies"].to_numpy(),
            "v": v,
            "n": norm,
            "f": (v / norm[:, None]).astype(np.float32),
            "p": np.stack(frame["p"].to_list()),
        }

    def pair(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["right", "place"], ignore_index=True)
        same = bool((frame["i"] == frame["j"]).iloc[0])
        left = side(frame[~frame["right"]])  # neither side is empty: nearness is mutual
        right = left if same else side(frame[frame["right"]])
        counts, edges = join_sequences(left, right, cosine, epsilon, same)
        both = [(left["id"], counts[0])] + ([] if same else [(right["id"], counts[1])])
        some = pd.concat([pd.DataFrame({"id": i[n > 0], "n": n[n > 0]}) for i, n in both])
        spans = pd.DataFrame({"id": edges[:, 0], "other": edges[:, 1]})
        return pd.concat([some, spans]).astype({"id": "int64", "n": "Int64", "other": "Int64"})[["id", "n", "other"]]

    needed = near_blocks(laid, pairs, lead, epsilon)
    needed = needed.withColumn("interval", F.when(F.col("right"), F.col("j")).otherwise(F.col("i")))
    rows = needed.join(laid.select("id", "copies", "v", "p", "place", "interval", "block"), ["interval", "block"])
    return rows.groupBy("i", "j").applyInPandas(pair, "id long, n long, other long")


def near_duplicates(
    df: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each input row.

    Equal vectors are one node with a number of copies, so a vector that fills a
    third of the table is compared once. Tasks return link counts and edges that span
    the links found, never all pairs. Vectors that are null, zero or hold null or
    non-finite components link with nothing: no links, a component of their own.
    Vectors of another length than the longest are compared as filled up with zeros.
    Rows that repeat an id are copies of one another in the component they share.
    """
    epsilon = float(np.sqrt(2 - 2 * cosine))
    good = usable(df, id_col, vector_col).where(F.exists("vector", lambda x: x != 0))
    width = good.agg(F.max(F.size("vector"))).first()[0] or 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column("vector"):
                values = np.asarray(row.values, dtype=np.float64)
                v = np.zeros(width)
                # scaled by the largest component: no square overflows or vanishes
                v[: len(values)] = values / np.abs(values).max()
                out.append((v / np.sqrt((v * v).sum())).tobytes())
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "v": pa.array(out, pa.binary())})

    packed = staged(good.mapInArrow(pack, "vec_id long, v binary").withColumn("key", F.sha2("v", 256)), "unit")
    nodes = packed.groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v")
    )
    nodes = staged(nodes, "nodes")
    basis = principal(nodes, width)
    laid = staged(in_order(nodes.select("id", "copies", "v"), basis, epsilon), "order")
    pairs = interval_pairs(laid, basis.shape[1], epsilon)
    found = staged(links(laid, pairs, width, basis.shape[1], cosine, epsilon), "links")
    sums = found.where("n is not null").groupBy("id").agg(F.sum("n").alias("n"))
    edges = found.where("other is not null").select(F.col("id").alias("u"), F.col("other").alias("v"))
    labels = components(edges).withColumnRenamed("node", "id")
    summed = (
        nodes.select("key", "id", "copies")
        .join(sums, "id", "left")
        .join(labels, "id", "left")
        .select(
            "key",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = packed.select("vec_id", "key").join(summed, "key").select("vec_id", "n_links", "component_id")
    vector = F.col(vector_col).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable_row = F.col(id_col).isNotNull() & vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)
    alone = df.where(~F.coalesce(usable_row, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.col(id_col).cast("long").alias("component_id"),
    )
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

"""Exact top-k inner products over a pivot-distance index.

Largest inner products are made nearest neighbours by one more coordinate that
gives all candidates the same norm. A candidate is keyed by its nearest pivot and
its distance to it; the distances of a pivot's candidates are cut into rings
(annuli). By the triangle inequality no candidate of a ring can score above a bound. A query
sorts the rings by their bounds and visits them in that order, in rounds of more and more
rings; the k-th score found so far is its bar, and it stops at the first ring whose bound
does not reach the bar. Candidates only travel to the blocks of queries that visit their ring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import staged

PIVOTS, MOST_PIVOTS = 16, 1024
"""Pivots: an eighth of the square root of the candidates, but from 16 to 1024, so that
the table of rings stays small."""
RINGS = 4
FIRST, GROWTH = 1, 4
"""Rings that a query visits in the first round, and how many times more in each later one."""
PART_ROWS = 4096
QUERY_ROWS = 2048
SLICE = 256
EXACT = float(1 << 53)
LOWEST = np.iinfo(np.int64).min


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector as doubles) of rows without null or non-finite components."""
    vector = F.col(vector_col).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad
    )


def matrix(column: pd.Series, width: int) -> np.ndarray:
    data = np.frombuffer(b"".join(column), np.float64)
    return data.reshape(len(column), width)


@dataclass
class Index:
    """What every task knows: pivots, the common norm, and the rings' extent."""

    pivots: np.ndarray
    norm2: float
    width: int
    rings: np.ndarray  # rows of (pivot, ring, count, nearest, farthest)

    def from_query(self, q: np.ndarray) -> np.ndarray:
        """Distances of queries to pivots in the space with the added coordinate."""
        square = (q * q).sum(1)[:, None] + self.norm2 - 2 * q @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))

    def from_candidate(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm2 - (x * x).sum(1), 0))
        own = np.sqrt(np.maximum(self.norm2 - (self.pivots**2).sum(1), 0))
        square = 2 * self.norm2 - 2 * (x @ self.pivots.T + np.outer(rest, own))
        return np.sqrt(np.maximum(square, 0))

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The most that any candidate of each ring can score, with room for rounding."""
        near = self.from_query(q)[:, self.rings[:, 0].astype(int)]
        gap = np.maximum(np.maximum(near - self.rings[:, 4], self.rings[:, 3] - near), 0)
        top = ((q * q).sum(1)[:, None] + self.norm2 - gap**2) / 2
        return top * (1 + 1e-9) + 1e-3


def prepare(vectors: DataFrame, scale: float, width: int) -> DataFrame:
    """(vec_id, v): components floor(scale * x) as packed doubles, zeros up to ``width``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column("vector"):
                v = np.zeros(width)
                values = np.asarray(row.values, dtype=np.float64)
                v[: len(values)] = np.floor(scale * values)
                out.append(v.tobytes())
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "v": pa.array(out, pa.binary())})

    return vectors.mapInArrow(run, "vec_id long, v binary")


def build(table: DataFrame, width: int, norm2: float) -> tuple[DataFrame, Index]:
    """Candidates with their place (ring number and part), and the index."""
    spark = table.sparkSession
    wanted = min(max(int(table.count() ** 0.5) // 8, PIVOTS), MOST_PIVOTS)
    drawn = table.orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id").limit(wanted).collect()
    pivots = np.stack([np.frombuffer(row["v"]) for row in drawn])
    index = Index(pivots, norm2, width, np.zeros((0, 5)))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                far = index.from_candidate(matrix(frame["v"], width))
                yield frame.assign(pivot=far.argmin(1).astype(np.int32), distance=far.min(1))

    keyed = staged(table.mapInPandas(assign, "vec_id long, v binary, pivot int, distance double"), "pivots")
    cuts = keyed.groupBy("pivot").agg(
        F.percentile_approx("distance", [(i + 1) / RINGS for i in range(RINGS - 1)], 1000).alias("cuts")
    )
    rows = [(row["pivot"], row["cuts"]) for row in cuts.collect()]
    edges = spark.createDataFrame(rows, "pivot int, cuts array<double>")
    ring = F.size(F.filter("cuts", lambda x: x < F.col("distance"))).cast("int")
    keyed = keyed.join(F.broadcast(edges), "pivot").withColumn("ring", ring).drop("cuts")
    extent = keyed.groupBy("pivot", "ring").agg(
        F.count(F.lit(1)).alias("n"), F.min("distance").alias("near"), F.max("distance").alias("far")
    )
    index.rings = np.array(sorted(map(tuple, extent.collect())), dtype=float)
    numbers = [(int(p), int(r), i, int(-(-n // PART_ROWS))) for i, (p, r, n, *_) in enumerate(index.rings)]
    places = spark.createDataFrame(numbers, "pivot int, ring int, place int, parts int")
    placed = keyed.join(F.broadcast(places), ["pivot", "ring"]).select(
        "vec_id", "v", "place", F.pmod(F.xxhash64("vec_id", F.lit("part")), "parts").cast("int").alias("part")
    )
    return placed, index


def leading(scores: np.ndarray, k: int) -> np.ndarray:
    """Marks the ``k`` highest scores of each row; of equal ones those further left."""
    size = scores.shape[1]
    if size <= k:
        return np.ones(scores.shape, bool)
    bar = np.partition(scores, size - k, axis=1)[:, size - k, None]
    above, level = scores > bar, scores == bar
    return above | (level & (np.cumsum(level, axis=1) <= k - above.sum(1, keepdims=True)))


def visit(queries: DataFrame, placed: DataFrame, parts: list[int], blocks: int, k: int, width: int) -> DataFrame:
    """Each query (query_id, q, bar, places) against the rings it names; at most k rows
    from each part of a ring, none below the bar."""

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(np.int64)
        if not len(left) or not len(right):
            return empty
        right = right.sort_values("vec_id", ignore_index=True)
        ids = right["vec_id"].to_numpy()
        x, q = matrix(right["v"], width), matrix(left["q"], width)
        own, bars = left["query_id"].to_numpy(), left["bar"].to_numpy()
        found = []
        for begin in range(0, len(q), SLICE):
            some = slice(begin, begin + SLICE)
            scores = np.rint(q[some] @ x.T).astype(np.int64)
            scores[own[some, None] == ids[None, :]] = LOWEST
            row, col = np.nonzero(leading(scores, k) & (scores >= bars[some][:, None]) & (scores > LOWEST))
            found.append(
                pd.DataFrame({"query_id": own[some][row], "vec_id": ids[col], "score": scores[row, col]})
            )
        return pd.concat(found) if found else empty

    part_counts = F.array(*map(F.lit, parts))
    asked = (
        queries.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit("block")), F.lit(blocks)).cast("int"))
        .withColumn("place", F.explode("places"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.get(part_counts, F.col("place")) - 1)))
        .select("query_id", "q", "bar", "place", "part", "block")
    )
    # a part goes to the blocks that ask for it, and to no other
    asking = asked.select(*(F.col(name).alias(name) for name in ("place", "part", "block"))).distinct()
    held = placed.join(asking, ["place", "part"])
    return (
        asked.groupBy("place", "part", "block")
        .cogroup(held.groupBy("place", "part", "block"))
        .applyInPandas(block, "query_id long, vec_id long, score long")
    )


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    df: DataFrame,
    every: int = 20,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query, exactly.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows
    with another id. Scores are inner products of the floors of ``scale`` times the
    components. Ties go to the smaller id. Null vectors, null ids and vectors with
    null or non-finite components take no part. Shorter vectors count as filled up
    with zeros. Rows that repeat an id are candidates of their own; of a query's rows the
    one whose packed components come first asks.
    Components too large for exact sums of products raise ``OverflowError``.
    """
    spark = df.sparkSession
    vectors = usable(df, id_col, vector_col)
    most = F.coalesce(F.array_max(F.transform("vector", F.abs)), F.lit(0.0))
    width, top = vectors.agg(F.max(F.size("vector")), F.max(most)).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if width is None:
        return empty
    width = max(width, 1)
    reach = np.floor(scale * top) + 1
    if reach * reach * width >= EXACT:
        raise OverflowError("components are too large for exact scores")
    table = staged(prepare(vectors, scale, width), "vectors")
    square = F.expr(f"aggregate(transform(vector, x -> pow(floor({scale} * x), 2)), 0D, (a, x) -> a + x)")
    norm2 = float(vectors.agg(F.max(square)).first()[0])
    placed, index = build(table, width, norm2)
    placed = staged(placed, "placed")
    parts = [int(-(-n // PART_ROWS)) for n in index.rings[:, 2]]

    asked = table.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    low, width_now = 0, FIRST
    while low < len(index.rings):
        bars = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("bar")).where(F.col("n") == k)
        barred = asked.join(bars.drop("n"), "query_id", "left").fillna(int(LOWEST), ["bar"])
        visitors = barred.mapInPandas(next_rings(index, width, low, low + width_now), "query_id long, q binary, bar long, places array<int>")
        visitors = staged(visitors, "visits")
        if visitors.isEmpty():
            break
        more = visit(visitors, placed, parts, blocks, k, width)
        found = staged(best(found.union(more), k).drop("rank"), "best")
        low, width_now = low + width_now, GROWTH * width_now
    return best(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def next_rings(index: Index, width: int, low: int, high: int):
    """Queries with those of their rings ``low`` to ``high``, in the order of bounds, that can
    still reach the bar; queries without one are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                places = wanted_rings(index.bounds(matrix(frame["q"], width)), frame["bar"].to_numpy(), low, high)
                frame = frame.assign(places=places)
                yield frame[frame["places"].map(len) > 0]

    return run


def wanted_rings(bounds: np.ndarray, bars: np.ndarray, low: int, high: int) -> list[list[int]]:
    order = np.argsort(-bounds, axis=1, kind="stable")[:, low:high]
    reach = np.take_along_axis(bounds, order, axis=1) >= bars[:, None]
    return [row[ok].tolist() for row, ok in zip(order, reach, strict=True)]

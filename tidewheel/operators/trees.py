"""Regression trees of a whole search, grown together on histograms.

Every row is a short array of bins. Rows of one fold with the same bins go the same way down
every tree, so they are first added up into one row: their number, mean label and squared deviation
from it, which is all that splits and errors ask for. There are at most (bins ** features) of
these a fold, however many rows. A level of all trees, of every fold and every setting,
is one job: tasks send the rows of their partition down the trees grown so far and add up
(rows, sum of the label) per tree, node, feature and bin; Spark adds the tasks' sums, and
windows over the bins of a node find its best split. What comes back is one row per split,
so the driver holds the trees and nothing that grows with the rows.

The depth of a tree and the rows a node needs to be split never change which split a node
gets, only whether it is made. So one tree per number of rows in a leaf, features per split
and fold is grown as deep as any setting asks; settings that stop earlier read the means of
inner nodes on the way down. The features that a node may split on are drawn by a hash of
the node's place, the same for all trees, so settings are compared on equal terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.keyed import uniform_of

NO_FOLD = -1
"""The fold of a tree that is grown on all training rows."""
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class Tree:
    """What tells grown trees apart: rows in a leaf, features per split, the fold left out."""

    leaf: int
    features: int
    fold: int


def features_per_split(kind: str | int, features: int) -> int:
    """``sqrt`` and ``log2`` of the number of features, at least one; a number is itself."""
    if kind == "sqrt":
        return max(1, int(math.sqrt(features)))
    if kind == "log2":
        return max(1, int(math.log2(features)))
    return min(int(kind), features)


def binned(df: DataFrame, features: Sequence[str], label: str, bins: int, *keep: str) -> DataFrame:
    """``(bins ARRAY<INT>, y DOUBLE, keep...)``: each feature in ``bins`` steps of equal width
    between its least and greatest value, found by one pass. Rows with a null or NaN feature
    or label are left out; a feature with one value has one bin."""
    numbers = [F.col(name).cast("double") for name in features]
    usable = F.lit(True)
    for column in (*numbers, F.col(label).cast("double")):
        usable &= column.isNotNull() & ~F.isnan(column)
    rows = df.where(usable)
    ends = rows.agg(*(f(x).alias(f"{f.__name__}{i}") for i, x in enumerate(numbers) for f in (F.min, F.max))).first()
    if ends[0] is None:
        raise ValueError("no rows to learn from")

    def step(i: int, x: Column) -> Column:
        low, high = ends[f"min{i}"], ends[f"max{i}"]
        if high == low:
            return F.lit(0)
        return F.least(F.lit(bins - 1), F.floor((x - F.lit(low)) / F.lit(high - low) * bins)).cast("int")

    cells = F.array(*(step(i, x) for i, x in enumerate(numbers)))
    return rows.select(cells.alias("bins"), F.col(label).cast("double").alias("y"), *keep)


def gathered(df: DataFrame) -> DataFrame:
    """The rows (bins, y, fold) added up by bins and fold: ``(bins, fold, n, y, spread)`` with
    their number, the mean of their labels and the sum of squared deviations from it. Work on
    these costs more than moving them, so they go to all cores, few as they may be."""
    n = F.count(F.lit(1))
    sums = df.groupBy("bins", "fold").agg(
        n.alias("n"), F.avg("y").alias("y"), (F.var_pop("y") * n).alias("spread")
    )
    cores = df.sparkSession.sparkContext.defaultParallelism
    return sums.repartition(max(cores, df.rdd.getNumPartitions()), "bins", "fold")


class Forest:
    """Trees as arrays by node; the children of node i are 2 i and 2 i + 1, the root is 1.

    Their size is bounded by the search: trees times two to the power of the depth.
    """

    def __init__(
        self, trees: Sequence[Tree], features: int, depth: int, bins: int, least: int = 2, seed: int = 42
    ) -> None:
        self.trees, self.features, self.depth, self.bins, self.least = list(trees), features, depth, bins, least
        shape = len(self.trees), 1 << (depth + 1)
        self.feature = np.full(shape, -1, np.int16)
        self.bin = np.zeros(shape, np.int16)
        self.rows = np.zeros(shape, np.int64)
        self.total = np.zeros(shape)
        #: features of each inner node, the ones tried first in front
        self.order = np.array([_feature_order(seed, node, features) for node in range(1 << depth)], np.int16)

    def paths(self, tree: int, x: np.ndarray, depth: int) -> np.ndarray:
        """Nodes of each row on its way down, a column per level; a leaf is repeated."""
        nodes = np.ones((len(x), depth + 1), np.int64)
        rows = np.arange(len(x))
        for level in range(depth):
            node = nodes[:, level]
            feature = self.feature[tree, node]
            below = 2 * node + (x[rows, np.maximum(feature, 0)] > self.bin[tree, node])
            nodes[:, level + 1] = np.where(feature < 0, node, below)
        return nodes

    def means(self, tree: int) -> np.ndarray:
        return self.total[tree] / np.maximum(self.rows[tree], 1)


def _feature_order(seed: int, node: int, features: int) -> list[int]:
    return sorted(range(features), key=lambda f: (uniform_of(f"{seed}:split", node, f), f))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _histograms(forest: Forest, depth: int):
    """Sums (cell, n, s) of a batch, a cell being a tree, node, feature and bin of the level."""
    width, bins, nodes = forest.features, forest.bins, 1 << (forest.depth + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y, rows = _matrix(batch.column("bins"), width), batch.column("y").to_numpy(), batch.column("n").to_numpy()
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for number, tree in enumerate(forest.trees):
                own = np.flatnonzero(fold != tree.fold)
                node = forest.paths(number, x[own], depth)[:, -1]
                able = (node >= 1 << depth) & (forest.rows[number, node] >= max(2 * tree.leaf, forest.least))
                own, node = own[able], node[able]
                if not len(own):
                    continue
                count, first = tree.features, 1 << depth
                tried = forest.order[node, :count].astype(np.int64)
                key = ((node - first)[:, None] * count + np.arange(count)) * bins + x[own[:, None], tried]
                key, many = key.ravel(), np.repeat(rows[own], count)
                weight = np.repeat(rows[own] * y[own], count)
                size = first * count * bins
                if size <= 4 * len(key):
                    found, place = np.arange(size), key
                else:  # few rows for many nodes
                    found, place = np.unique(key, return_inverse=True)
                n = np.bincount(place, many, len(found)).astype(np.int64)
                s = np.bincount(place, weight, len(found))
                full = np.flatnonzero(n)
                slot, step = np.divmod(found[full], bins)
                node, nth = first + slot // count, slot % count
                cell = ((number * nodes + node) * width + forest.order[node, nth]) * bins + step
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n[full]), pa.array(s[full])], ["cell", "n", "s"])

    return run


def best_splits(sums: DataFrame, forest: Forest) -> DataFrame:
    """(node, split) of every node that has a split with enough rows on both sides: the one
    that takes most off the squared error; of equals the smaller feature, then bin. Gains
    are compared in single precision, so that two splits into the same rows are equals in
    whatever order their sums were added."""
    bins, width, nodes = forest.bins, forest.features, 1 << (forest.depth + 1)
    cells = sums.select(
        F.floor(F.col("cell") / bins).alias("slot"), (F.col("cell") % bins).alias("bin"), "n", "s"
    )
    whole = Window.partitionBy("slot")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sides = cells.select(
        F.floor(F.col("slot") / width).alias("node"),
        (F.col("slot") % width).alias("feature"),
        "bin",
        F.sum("n").over(upto).alias("n1"),
        F.sum("s").over(upto).alias("s1"),
        F.sum("n").over(whole).alias("n"),
        F.sum("s").over(whole).alias("s"),
    )
    leaf = F.element_at(F.array(*(F.lit(tree.leaf) for tree in forest.trees)), (F.floor(F.col("node") / nodes) + 1).cast("int"))
    n2, s2 = F.col("n") - F.col("n1"), F.col("s") - F.col("s1")
    enough = (F.col("n1") >= leaf) & (n2 >= leaf) & (n2 > 0)
    gain = F.col("s1") ** 2 / F.col("n1") + s2**2 / n2 - F.col("s") ** 2 / F.col("n")
    split = F.struct(gain.cast("float").alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "n1", "s1", "n", "s")
    best = sides.where(enough).groupBy("node").agg(F.max(split).alias("split"))
    return best.where(F.col("split.gain") > LEAST_GAIN)


def grow(
    data: DataFrame,
    trees: Sequence[Tree],
    features: int,
    depth: int,
    bins: int,
    least: int = 2,
    seed: int = 42,
) -> Forest:
    """All ``trees`` on ``data``, as :func:`gathered`; a tree leaves out the rows of its fold.
    Nodes with fewer than ``least`` rows are not split.

    One job per level, and nothing but its splits comes back from it.
    """
    forest = Forest(trees, features, depth, bins, least, seed)
    rows = data.groupBy("fold").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("s")).collect()
    for number, tree in enumerate(forest.trees):
        forest.rows[number, 1] = sum(row["n"] for row in rows if row["fold"] != tree.fold)
        forest.total[number, 1] = math.fsum(row["s"] for row in rows if row["fold"] != tree.fold)
    nodes = 1 << (depth + 1)
    for level in range(depth):
        sums = data.mapInArrow(_histograms(forest, level), "cell long, n long, s double")
        sums = sums.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        splits = best_splits(sums, forest).collect()
        if not splits:
            break
        for row in splits:
            (tree, node), split = divmod(row["node"], nodes), row["split"]
            forest.feature[tree, node], forest.bin[tree, node] = -split["f"], -split["b"]
            for child, n, s in (
                (2 * node, split["n1"], split["s1"]),
                (2 * node + 1, split["n"] - split["n1"], split["s"] - split["s1"]),
            ):
                forest.rows[tree, child], forest.total[tree, child] = n, s
    return forest


@dataclass(frozen=True)
class Stops:
    """The depths and numbers of rows in a split node that trees are read at."""

    depths: tuple[int, ...]
    rows: tuple[int, ...]


def squared_errors(data: DataFrame, forest: Forest, stops: Stops) -> np.ndarray:
    """Mean squared error of each tree, depth and least rows of a split node: on the rows of
    a tree's fold, or on all of ``data`` (see :func:`gathered`) for a tree that left out none. All
    models are scored in one pass, in which a task sends on one sum per model."""
    shape = len(forest.trees), len(stops.depths), len(stops.rows)
    width, size = forest.features, math.prod(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        error, count = np.zeros(shape), np.zeros(shape)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("bins"), width)
            y, n, spread = (batch.column(name).to_numpy() for name in ("y", "n", "spread"))
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            for number, tree in enumerate(forest.trees):
                own = np.arange(len(y)) if tree.fold == NO_FOLD else np.flatnonzero(fold == tree.fold)
                paths = forest.paths(number, x[own], max(stops.depths))
                means, rows = forest.means(number)[paths], forest.rows[number][paths]
                at, many, within = np.arange(len(own)), n[own], spread[own].sum()
                for j, least in enumerate(stops.rows):
                    # a node with too few rows is where the way down ends
                    level = np.where((rows < least).any(1), (rows < least).argmax(1), paths.shape[1] - 1)
                    for i, depth in enumerate(stops.depths):
                        off = means[at, np.minimum(level, depth)] - y[own]
                        error[number, i, j] += (off * many) @ off + within
                        count[number, i, j] += many.sum()
        cells = pa.array(np.arange(size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([cells, pa.array(error.ravel()), pa.array(count.ravel())], ["cell", "error", "n"])

    sums = data.mapInArrow(run, "cell int, error double, n double").groupBy("cell").agg(F.sum("error"), F.sum("n"))
    out = np.full(size, np.nan)
    for cell, error, n in sums.collect():
        out[cell] = error / n if n else np.nan
    return out.reshape(shape)


Config = Mapping[str, object]


@dataclass(frozen=True)
class Search:
    """The result of a search: a row per config, and the forest that gave it."""

    metrics: list[float]
    refit: list[float]
    forest: Forest


def search(
    train: DataFrame,
    configs: Sequence[Config],
    features: int,
    bins: int,
    folds: int = 0,
    test: DataFrame | None = None,
    seed: int = 42,
) -> Search:
    """Mean squared errors of all ``configs`` (max_depth, min_samples_split,
    min_samples_leaf, max_features).

    With ``folds``, ``metrics`` are means over the folds of ``train`` (bins, y, fold). ``refit``
    holds the error on ``test`` of each config's tree on all training rows, if there is a
    ``test``. Every config and fold has its own tree in effect; those that are parts of a
    larger one are read off it.
    """
    kinds = list(dict.fromkeys((int(c["min_samples_leaf"]), features_per_split(c["max_features"], features)) for c in configs))
    left_out = [*range(folds), *([NO_FOLD] if test is not None else [])]
    trees = [Tree(leaf, tried, fold) for leaf, tried in kinds for fold in left_out]
    depths = tuple(sorted({int(c["max_depth"]) for c in configs}))
    stops = Stops(depths, tuple(sorted({int(c["min_samples_split"]) for c in configs})))
    train = gathered(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        forest = grow(train, trees, features, max(depths), bins, max(2, min(stops.rows)), seed)
        inner = squared_errors(train, forest, stops)
    finally:
        train.unpersist()
    outer = squared_errors(gathered(test), forest, stops) if test is not None else inner

    def error(config: Config, fold: int, errors: np.ndarray) -> float:
        kind = int(config["min_samples_leaf"]), features_per_split(config["max_features"], features)
        tree = trees.index(Tree(*kind, fold))
        return float(errors[tree, depths.index(config["max_depth"]), stops.rows.index(config["min_samples_split"])])

    metrics = [float(np.mean([error(c, fold, inner) for fold in range(folds)])) if folds else math.nan for c in configs]
    refit = [error(c, NO_FOLD, outer) if test is not None else math.nan for c in configs]
    return Search(metrics, refit, forest)

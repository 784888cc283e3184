"""Trees grown together against trees grown one by one."""

import itertools

import numpy as np
import pytest

from tidewheel.operators import trees

BINS = 8
FEATURES = 5


def table(seed=0, rows=400):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, BINS, (rows, FEATURES))
    y = x[:, 0] * 3.0 + np.where(x[:, 1] > 4, 10, 0) * (x[:, 2] > 2) + rng.normal(size=rows)
    return x, y, rng.integers(0, 3, rows)


def frame(spark, x, y, fold):
    rows = [(row.tolist(), float(v), int(k)) for row, v, k in zip(x, y, fold, strict=True)]
    return spark.createDataFrame(rows, "bins array<int>, y double, fold int").repartition(4)


def plain_tree(x, y, config, node=1, depth=0):
    """A nested tree that honours all four settings while it grows."""
    mean = y.mean()
    if depth == config["max_depth"] or len(y) < config["min_samples_split"]:
        return mean
    tried = trees._feature_order(42, node, FEATURES)[: trees.features_per_split(config["max_features"], FEATURES)]
    best = None
    for f in sorted(tried):
        for b in np.unique(x[:, f]):
            low = x[:, f] <= b
            n1, n2 = low.sum(), (~low).sum()
            if min(n1, n2) < config["min_samples_leaf"] or not n2:
                continue
            gain = y[low].sum() ** 2 / n1 + y[~low].sum() ** 2 / n2 - y.sum() ** 2 / len(y)
            if gain > trees.LEAST_GAIN and (best is None or np.float32(gain) > best[0]):
                best = np.float32(gain), f, b
    if best is None:
        return mean
    _, f, b = best
    low = x[:, f] <= b
    return (
        f,
        b,
        plain_tree(x[low], y[low], config, 2 * node, depth + 1),
        plain_tree(x[~low], y[~low], config, 2 * node + 1, depth + 1),
    )


def predict(tree, row):
    while isinstance(tree, tuple):
        f, b, low, high = tree
        tree = low if row[f] <= b else high
    return tree


def plain_error(train, test, config):
    tree = plain_tree(*train, config)
    return np.mean([(predict(tree, row) - y) ** 2 for row, y in zip(*test, strict=True)])


AXES = {
    "max_depth": (1, 2, 4, 7),
    "min_samples_split": (2, 9, 30),
    "min_samples_leaf": (1, 6),
    "max_features": ("sqrt", "log2", 5),
}
CONFIGS = [dict(zip(AXES, values, strict=True)) for values in itertools.product(*AXES.values())]


def test_search_matches_single_trees(spark):
    x, y, fold = table()
    other = table(1, 100)
    found = trees.search(frame(spark, x, y, fold), CONFIGS, FEATURES, BINS, 3, frame(spark, *other[:2], other[2] * 0 + 9))
    for config, metric, refit in zip(CONFIGS, found.metrics, found.refit, strict=True):
        folds = []
        for k in range(3):
            own = fold == k
            folds.append(plain_error((x[~own], y[~own]), (x[own], y[own]), config))
        assert metric == pytest.approx(np.mean(folds)), config
        assert refit == pytest.approx(plain_error((x, y), other[:2], config)), config
    # three kinds of features per split come to two
    assert len(found.forest.trees) == 2 * 2 * 4


def test_bins_of_equal_width(spark):
    rows = [(0.0, 5.0, 1.0), (1.0, 5.0, 2.0), (0.24, 5.0, 3.0), (0.25, 5.0, 4.0), (None, 5.0, 1.0), (float("nan"), 5.0, 1.0), (0.1, 5.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    got = sorted((r["y"], r["bins"]) for r in trees.binned(df, ["a", "b"], "y", 4).collect())
    assert got == [(1.0, [0, 0]), (2.0, [3, 0]), (3.0, [0, 0]), (4.0, [1, 0])]
    with pytest.raises(ValueError):
        trees.binned(df.where("a > 9"), ["a", "b"], "y", 4)


def test_constant_labels_make_no_split(spark):
    x, _, fold = table()
    found = trees.search(frame(spark, x, np.ones(len(x)), fold), CONFIGS[:3], FEATURES, BINS, 3)
    assert found.metrics == [0.0] * 3 and (found.forest.feature == -1).all()


def test_best_of_search_is_refitted(spark, folder):
    from tidewheel.plans.registry import QUERIES

    every = QUERIES["cv_grid_tree"](spark, folder).collect()
    best = QUERIES["cv_grid_best"](spark, folder).first()
    assert len(every) == 420 and all(row["score"] == -row["mse"] for row in every)
    top = max(every, key=lambda row: (row["score"], -row["trial_id"]))
    assert best["score"] == top["score"] and 0 < best["test_mse"] < 4 * best["mse"]
    drawn = QUERIES["holdout_search_tree"](spark, folder).collect()
    assert len(drawn) == 210
    assert QUERIES["holdout_search_best"](spark, folder).first()["mse"] == min(row["mse"] for row in drawn)


def test_rows_alike_are_added_up_before_trees(spark):
    x, y, fold = table()
    y = y + 1e8  # deviations have to survive large labels
    often = [np.concatenate([values] * 3) for values in (x % 2, y, fold)]
    often[1] += np.repeat([0.0, 1.0, 5.0], len(y))
    rows = trees.gathered(frame(spark, *often))
    assert rows.count() <= 3 * 2**FEATURES and rows.agg({"n": "sum"}).first()[0] == 3 * len(y)
    for row in rows.collect():
        own = often[1][(often[0] == row["bins"]).all(1) & (often[2] == row["fold"])]
        assert row["n"] == len(own) and row["y"] == pytest.approx(own.mean(), rel=1e-14)
        assert row["spread"] == pytest.approx(((own - own.mean()) ** 2).sum(), rel=1e-6)
    config = {"max_depth": 3, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": 5}
    often[1] -= 1e8  # gains of splits are not made for these
    found = trees.search(frame(spark, *often), [config], FEATURES, BINS, 3)
    folds = []
    for k in range(3):
        own = often[2] == k
        folds.append(plain_error((often[0][~own], often[1][~own]), (often[0][own], often[1][own]), config))
    assert found.metrics[0] == pytest.approx(np.mean(folds), rel=1e-6)

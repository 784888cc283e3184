import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import boosting, scratch, search, trials
from tidewheel.plans import searching

CONFIG = {"n_estimators": 3, "learning_rate": 0.5, "max_depth": 3, "subsample": 1.0, "colsample_bytree": 1.0}


def table(spark, count=300):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (count, 4)).astype(float)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] / 4 + rng.normal(size=count) * 3) // 5).clip(0, 2).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(count)], "id int, xs array<double>, class int")
    return search.training_rows(trials.kfold_stratified(df, "class", "id", 2), "xs", "class", "fold")


def test_the_query_searches_the_whole_space(spark, folder, monkeypatch):
    """100 draws of 100 to 300 rounds in five folds."""
    asked = []

    def noted(rows, fold, k, configs, spec):
        asked.append((rows, k, configs))
        return spark.sql("SELECT 0 AS trial_id, named_struct('a', 0) AS config, 0.5D AS accuracy")

    monkeypatch.setattr(search, "cross_validated", noted)
    searching.cv_random_boost(spark, folder)
    ((rows, k, configs),) = asked
    assert len(configs) == 100 and len({tuple(config.values()) for config in configs}) == 100
    assert {config["n_estimators"] for config in configs} == {100, 200, 300}
    assert k == 5 and {row.fold for row in rows.select("fold").distinct().collect()} == set(range(5))


def test_one_tree_a_class_is_that_of_spark(spark):
    rows = table(spark).persist()
    spec, config = search.boost_spec(), CONFIG | {"n_estimators": 1}
    parts = []
    for i in range(2):
        model = search.refit(rows.where(F.col("fold") != i), config, spec)
        parts.append(spec.evaluator.evaluate(model.transform(rows.where(F.col("fold") == i))))
    assert search.cross_validated(rows, "fold", 2, [config], spec).first().accuracy == pytest.approx(np.mean(parts))


def by_hand(x, y, train, setting):
    """Raw scores of one binary model, all splits tried one by one."""
    score, sign = np.zeros(len(y)), np.where(y, 1.0, -1.0)

    def fit(own, residual, rows, depth):
        best = (boosting.LEAST_GAIN, None)
        for f in range(x.shape[1]) if depth else ():
            for cut in np.unique(x[own, f])[:-1]:
                left = own[x[own, f] <= cut]
                right = own[x[own, f] > cut]
                gain = residual[own].var() - (residual[left].var() * len(left) + residual[right].var() * len(right)) / len(own)
                if gain > best[0] + 1e-12:
                    best = gain, (f, cut, left, right)
        if best[1] is None:
            return np.full(len(rows), residual[own].mean())
        f, cut, left, right = best[1]
        out = np.empty(len(rows))
        low = x[rows, f] <= cut
        out[low], out[~low] = fit(left, residual, rows[low], depth - 1), fit(right, residual, rows[~low], depth - 1)
        return out

    for number in range(setting.rounds):
        residual = 4 * sign / (1 + np.exp(2 * sign * score)) if number else sign
        score += (setting.rate if number else 1) * fit(np.flatnonzero(train), residual, np.arange(len(y)), setting.depth)
    return score


@pytest.mark.parametrize("chunk", [boosting.CHUNK, 37])
def test_scores_by_hand(monkeypatch, chunk):
    """Also with rows in several chunks and all arrays in files."""
    monkeypatch.setattr(boosting, "CHUNK", chunk)
    monkeypatch.setattr(scratch, "IN_MEMORY", 8 << 20 if chunk > 1000 else 0)
    rng = np.random.default_rng(7)
    bins = rng.integers(0, 9, (150, 3)).astype(np.uint8)
    y = ((bins[:, 0] > 4) + (bins[:, 1] * bins[:, 2] > 16) + (rng.uniform(size=150) < 0.2)).clip(0, 2).astype("i4")
    fold = rng.integers(0, 3, 150).astype("i4")
    setting = boosting.Setting(4, 0.3, 3, 1.0, 1.0)
    got = boosting.Booster(fold, y, bins, 3, 1).scores(setting, 1)
    for kind in range(3):
        assert got[kind] == pytest.approx(by_hand(bins.astype(int), y == kind, fold != 1, setting), abs=1e-9)


def test_draws_do_not_depend_on_how_rows_lie(spark):
    """And every setting and fold has a result of its own."""
    rows = table(spark)
    configs = [CONFIG | {"subsample": share, "colsample_bytree": share} for share in (0.5, 0.7, 1.0)]
    found = [
        search.cross_validated(rows.repartition(n), "fold", 2, configs, search.boost_spec()).orderBy("trial_id").collect()
        for n in (1, 5)
    ]
    assert found[0] == found[1] and len(found[0]) == 3 and len({row.accuracy for row in found[0]}) > 1


def test_nodes_draw_the_share_of_features(monkeypatch):
    seen, plain = [], boosting._best
    monkeypatch.setattr(boosting, "_best", lambda n1, s1, allowed: seen.append(allowed.sum(1).tolist()) or plain(n1, s1, allowed))
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 32, (200, 10)).astype(np.uint8)
    booster = boosting.Booster(np.zeros(200, "i4"), rng.integers(0, 2, 200).astype("i4"), bins, 2, 1)
    booster.scores(boosting.Setting(2, 0.3, 4, 0.7, 0.5), 1)
    assert {count for level in seen for count in level} == {5}


def test_odd_rows_are_told(spark):
    df = spark.range(2).selectExpr("cast(id AS int) AS fold", "cast(id AS int) AS class", "array(1D, double('NaN')) AS xs")
    with pytest.raises(ValueError, match="inside a feature vector"):
        search.cross_validated(search.training_rows(df, "xs", "class", "fold"), "fold", 2, [CONFIG], search.boost_spec())
    df = spark.range(2).selectExpr("cast(id AS int) AS fold", "if(id = 0, null, 1) AS class", "array(1D) AS xs")
    with pytest.raises(ValueError, match="numbers of classes"):
        search.cross_validated(search.training_rows(df, "xs", "class", "fold"), "fold", 2, [CONFIG], search.boost_spec())


def test_work_is_shared_out():
    costs = [9, 1, 1, 1, 5, 4]
    groups = boosting.shared_out(costs, 3)
    assert sorted(place for group in groups for place in group) == list(range(6))
    assert max(sum(costs[place] for place in group) for group in groups) == 9
    assert boosting.shared_out([1, 1], 5) == [[0], [1]]


def test_files_of_a_task_have_no_name(tmp_path, monkeypatch):
    monkeypatch.setenv("SPARK_LOCAL_DIRS", f"{tmp_path}/gone,{tmp_path}")
    monkeypatch.setattr(scratch, "IN_MEMORY", 0)
    spool = scratch.Spool("f8", 2)
    for begin in (0, 4, 4):
        spool.add(np.arange(begin * 2.0, 8).reshape(-1, 2))
    assert spool.array().tolist() == np.arange(8.0).reshape(-1, 2).tolist()
    held = scratch.zeros((3, 2), "f8")
    held[1] += 1
    assert held.tolist() == [[0, 0], [1, 1], [0, 0]] and isinstance(held, np.memmap)
    assert scratch.Spool("i4").array().tolist() == [] and os.listdir(tmp_path) == []

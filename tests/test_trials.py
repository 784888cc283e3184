import math
from collections import Counter

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param import Param, Params
from pyspark.sql import functions as F

from tests.helpers import assert_same_rows, plan_of
from tidewheel.operators import search, trials
from tidewheel.operators.ordering import Layout


@pytest.fixture(scope="module")
def one(spark):
    return spark.range(1).withColumnRenamed("id", "search_id")


def test_grids_have_every_configuration_once(one):
    for space, size in [(search.TREE_GRID, 420), (search.BOOST_GRID, 3240)]:
        grid = trials.grid_configs(one, "search_id", space)
        assert trials.grid_size(space) == size
        assert grid.count() == grid.select("config").distinct().count() == size
        for name, axis in space.items():
            values = {r[0] for r in grid.select(f"config.{name}").distinct().collect()}
            assert values == set(axis.values)


def test_grid_sample_has_no_repeats(spark):
    searches = spark.range(3).withColumnRenamed("id", "search_id")
    drawn = trials.sample_grid(searches, "search_id", search.BOOST_GRID, 100, 1)
    assert drawn.groupBy("search_id").agg(F.countDistinct("config_id").alias("n")).collect() == [
        (i, 100) for i in range(3)
    ]
    assert drawn.select("search_id", "draw", "config").where("draw >= 100").count() == 0
    assert drawn.groupBy("config_id").count().count() > 250
    everything = trials.sample_grid(searches, "search_id", search.TREE_GRID, 10_000, 1)
    assert everything.count() == 3 * 420


@pytest.mark.parametrize("size", [1, 2, 7, 12, 420, 1009, 3240])
def test_keyed_shuffle_is_a_permutation(spark, size):
    keys = spark.range(3).withColumnRenamed("id", "k")
    rows = keys.select("k", F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("i"))
    rows = rows.withColumn("p", trials.permuted(F.col("i"), size, "t", "k"))
    for found in rows.groupBy("k").agg(F.sort_array(F.collect_list("p")).alias("ps")).collect():
        assert found.ps == list(range(size))
    if size > 100:
        assert rows.where("i = p").count() < size / 10
        assert rows.groupBy("i").agg(F.countDistinct("p").alias("n")).where("n = 1").count() < size / 10


def test_grid_of_a_thousand_million(spark):
    space = {f"a{i}": trials.GridAxis(tuple(range(10))) for i in range(9)}
    assert trials.grid_size(space) == 10**9
    drawn = trials.sample_grid(spark.range(2), "id", space, 50_000, 1)
    assert drawn.groupBy("id").agg(F.countDistinct("config").alias("n")).collect() == [(0, 50_000), (1, 50_000)]
    spread = drawn.groupBy("config.a0").count().collect()
    assert len(spread) == 10 and all(9_000 < row["count"] < 11_000 for row in spread)


def test_sample_space_repeats_the_grid_axis(spark):
    rows = trials.sample_space(spark.range(100), "id", search.OBJECTIVE_SPACE, 3)
    assert rows.count() == 300 and rows.select("trial_id").distinct().count() == 300
    by_a = rows.groupBy("config.a").count().collect()
    assert sorted(by_a) == [(0.001, 100), (0.01, 100), (0.1, 100)]
    for config in (r.config for r in rows.collect()):
        assert config.b in (1, 2, 3, 4, 5)
        assert 0 <= config.c < 4 * math.pi
        assert 1e-5 <= config.d <= 1e3
        assert config.e == int(config.e) and 1 <= config.e <= 200


def test_search_is_native_and_picks_the_minimum(spark):
    scored = search.search_objective(trials.sample_space(spark.range(100), "id", search.OBJECTIVE_SPACE))
    plan = plan_of(scored)
    assert not any(name in plan for name in ("EvalPython", "MapIn", "Exchange", "Join"))
    best = trials.best_trial(scored, "score").first()
    c = best.config
    expected = c.a**2 + c.b * math.sin(c.c) + math.log(abs(c.d) + 1) * c.e**2
    assert best.score == pytest.approx(expected)
    assert best.score == scored.agg(F.min("score")).first()[0]


def test_best_trial_ties_and_gaps(spark):
    rows = [(3, 1.0), (2, 1.0), (1, None), (0, float("nan")), (5, 9.0), (4, 9.0)]
    df = spark.createDataFrame(rows, "trial_id int, m double")
    assert trials.best_trial(df, "m", "min").first().trial_id == 2
    assert trials.best_trial(df, "m", "max").first().trial_id == 4
    assert trials.best_trial(df.where("m IS NULL"), "m").count() == 0
    assert "Sort [" not in plan_of(trials.best_trial(df, "m"))
    with pytest.raises(ValueError):
        trials.best_trial(df, "m", "best")


def test_sample_choice(spark):
    drawn = trials.sample_choice(spark.range(2), "id", search.TREE_CHOICES, 210, 5)
    assert drawn.count() == 420
    assert drawn.where("id = 0").select("config").distinct().count() < 210
    for name, axis in search.TREE_CHOICES.items():
        assert {r[0] for r in drawn.select(f"config.{name}").distinct().collect()} == set(axis.values)


@pytest.mark.parametrize(("n", "fraction", "wanted"), [(5000, 0.2, 1000), (7, 0.2, 2), (10, 0.3, 3), (1, 0.5, 1)])
def test_exact_holdout(spark, n, fraction, wanted):
    split = trials.holdout_exact(spark.range(n), "id", fraction)
    assert split.where("is_test").count() == wanted
    assert split.where("NOT is_test").count() == n - wanted
    assert "Exchange" not in plan_of(split) and "Join" not in plan_of(split)


def test_holdout_share(spark):
    split = trials.holdout_split(spark.range(20000), "id")
    assert abs(split.where("is_test").count() / 20000 - 0.2) < 0.01


def test_folds(spark):
    rows = spark.range(1000).withColumn("label", F.when(F.col("id") % 3 > 0, "hot").otherwise("rare"))
    folds = trials.kfold(rows, "id", 5)
    assert sorted(r.fold for r in folds.select("fold").distinct().collect()) == [0, 1, 2, 3, 4]
    layout = Layout(rows_per_chunk=100)
    dealt = trials.kfold_stratified(rows, "label", "id", 5, layout=layout)
    sizes = dealt.groupBy("label", "fold").count()
    spread = sizes.groupBy("label").agg((F.max("count") - F.min("count")).alias("d")).collect()
    assert all(r.d <= 1 for r in spread) and dealt.count() == 1000
    assert_same_rows(dealt, trials.kfold_stratified(rows, "label", "id", 5))


def _table(spark, n=300):
    rows = spark.range(n).select(
        "id", F.array((F.col("id") % 10).cast("double"), (F.col("id") % 7).cast("double")).alias("xs")
    )
    return rows.withColumn("y", F.col("xs")[0] * 2 + F.col("xs")[1])


def test_trials_that_differ_in_unused_axes_share_a_fit(spark):
    configs = [
        {"max_depth": d, "min_samples_split": s, "min_samples_leaf": 1, "max_features": "sqrt"}
        for d in (1, 4)
        for s in (2, 5)
    ]
    spec = search.tree_spec()
    rows = search.training_rows(trials.kfold(_table(spark), "id", 2), "xs", "y", "fold")
    scored = {r.trial_id: r.mse for r in search.cross_validated(rows, "fold", 2, configs, spec).collect()}
    assert scored[0] == scored[1] and scored[2] == scored[3] and scored[2] < scored[0]
    best = min(scored, key=scored.get)
    assert search.refit(rows, configs[best], spec).getNumTrees == 1


def test_holdout_scored_finds_the_deeper_tree(spark):
    split = trials.holdout_split(_table(spark), "id")
    configs = [
        {"max_depth": d, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": "log2"}
        for d in (1, 6)
    ]
    train = search.training_rows(split.where("NOT is_test"), "xs", "y")
    test = search.training_rows(split.where("is_test"), "xs", "y")
    scored = search.holdout_scored(train, test, configs, search.tree_spec(), parallelism=2)
    assert trials.best_trial(scored, "mse").first().config.max_depth == 6


def test_cross_validation_by_hand(spark):
    rows = search.training_rows(trials.kfold(_table(spark), "id", 3), "xs", "y", "fold").persist()
    config = {"max_depth": 3, "min_samples_split": 2, "min_samples_leaf": 2, "max_features": "sqrt"}
    spec = search.tree_spec()
    errors = []
    for fold in range(3):
        model = search.refit(rows.where(F.col("fold") != fold), config, spec)
        errors.append(spec.evaluator.evaluate(model.transform(rows.where(F.col("fold") == fold))))
    scored = search.cross_validated(rows, "fold", 3, [config], spec).first()
    assert scored.mse == pytest.approx(sum(errors) / 3)


def test_boosting_learns_three_classes(spark):
    rows = spark.range(240).select(
        "id", (F.col("id") % 3).cast("int").alias("class"),
        F.array((F.col("id") % 3).cast("double"), (F.col("id") % 5).cast("double")).alias("xs"),
    )
    rows = trials.kfold_stratified(rows, "class", "id", 2)
    config = {
        "n_estimators": 2, "learning_rate": 0.5, "max_depth": 2, "subsample": 1.0, "colsample_bytree": 1.0
    }
    train = search.training_rows(rows, "xs", "class", "fold")
    assert search.cross_validated(train, "fold", 2, [config], search.boost_spec()).first().accuracy == 1


class _Recorder(Estimator):
    """Notes the partitions of the rows of every fit; its model predicts the depth."""

    depth = Param(Params._dummy(), "depth", "")
    seen = []

    def _fit(self, dataset):
        _Recorder.seen.append(dataset.rdd.getNumPartitions())
        return _Constant(self.getOrDefault(self.depth))


class _Constant(Model):
    def __init__(self, value):
        super().__init__()
        self.value = value

    def _transform(self, dataset):
        return dataset.withColumn("prediction", F.lit(float(self.value)))


def test_fits_take_no_tasks_for_empty_partitions(spark):
    rows = spark.range(600).repartition(64, "id").select(
        F.array(F.col("id") * 1.0).alias("xs"), (F.col("id") % 7).alias("y"), (F.col("id") % 2).cast("int").alias("fold")
    )
    train = search.training_rows(rows, "xs", "y", "fold")
    recorder = _Recorder()
    spec = search.ModelSpec(
        recorder, {"depth": recorder.depth}, {}, RegressionEvaluator(labelCol="label", metricName="mse"), "mse"
    )
    _Recorder.seen.clear()
    scored = search.cross_validated(train, "fold", 2, [{"depth": 1}, {"depth": 2}], spec).collect()
    assert _Recorder.seen == [1] * 4  # and the best config is not fitted again
    errors = [sum((i % 7 - row.config.depth) ** 2 for i in range(600)) / 600 for row in scored]
    assert [row.mse for row in scored] == pytest.approx(errors)
    with pytest.raises(ValueError, match="empty"):
        search.cross_validated(train.where("fold = 0"), "fold", 2, [{"depth": 1}], spec)
    with pytest.raises(SparkRuntimeException, match="Fold number"):
        search.cross_validated(train, "fold", 1, [{"depth": 1}], spec)


def test_rows_are_dealt_evenly_and_alike(spark, monkeypatch):
    rows = search.training_rows(
        spark.range(600).select(F.array(F.col("id") % 50 * 1.0).alias("xs"), F.lit(1).alias("y")), "xs", "y"
    )
    few = rows.repartition(3)
    assert search.dealt(few) is few
    monkeypatch.setattr(search, "ROWS_PER_TASK", 100)
    parts = [search.dealt(few).rdd.glom().collect() for _ in range(2)]
    assert all(97 <= size <= 103 for size in map(len, parts[0])) and parts[0] == parts[1]
    assert Counter(row.features[0] for part in parts[0] for row in part) == {float(i): 12 for i in range(50)}


def test_whole_grid_is_ranked_per_search(spark):
    import hashlib

    space = {"a": trials.GridAxis((1, 2, 3)), "b": trials.GridAxis(tuple(range(7)))}
    rows = trials.ranked_grid(spark.range(5), "id", space, 4, 3).collect()
    for key in range(5):
        ranks = sorted((hashlib.md5(f"3:grid:{key}:{i}".encode()).hexdigest(), i) for i in range(21))
        own = sorted((row for row in rows if row["id"] == key), key=lambda row: row["draw"])
        assert [(row["draw"], row["config_id"]) for row in own] == [(d, i) for d, (_, i) in enumerate(ranks[:4])]
        assert all(row["config"] == (row["config_id"] // 7 + 1, row["config_id"] % 7) for row in own)
    assert trials.ranked_grid(spark.range(2), "id", space, 50, 3).count() == 42


def test_the_query_ranks_every_configuration(spark, folder):
    from tidewheel.plans.registry import ORACLES, QUERIES

    assert "row_number()" in ORACLES["sample_grid"] and "range(3240)" in ORACLES["sample_grid"]
    plan = QUERIES["sample_grid"](spark, folder)._jdf.queryExecution().analyzed().toString()
    assert "array_sort" in plan and "3239" in plan

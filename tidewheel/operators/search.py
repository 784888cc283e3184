"""Scoring of trials: a closed formula on the JVM, or models fitted by Spark ML.

Spark's tree has no minimum rows per split and its boosting samples columns per
node, not per tree. Those axes stay in the trial table as asked for, but take
no part in a fit; trials that differ only there share one fit. Boosted models are cross-validated
all together (see :mod:`tidewheel.operators.boosting`), not one fit after another.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.evaluation import (
    Evaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import boosting
from tidewheel.operators.trials import Choice, GridAxis, LogUniform, QUniform, Uniform

# The search spaces the results are compared on.
OBJECTIVE_SPACE = {
    "a": GridAxis((0.001, 0.01, 0.1)),
    "b": Choice((1, 2, 3, 4, 5)),
    "c": Uniform(0.0, 4 * 3.141592653589793),
    "d": LogUniform(1e-5, 1e3),
    "e": QUniform(1, 200, 1),
}
TREE_VALUES = {
    "max_depth": (2, 4, 6, 8, 10, 12, 14),
    "min_samples_split": (2, 5, 10, 15, 20),
    "min_samples_leaf": (1, 2, 4, 6, 8, 10),
    "max_features": ("sqrt", "log2"),
}
BOOST_VALUES = {
    "n_estimators": (100, 200, 300),
    "learning_rate": tuple(10 ** (-3 + 3 * i / 29) for i in range(30)),
    "max_depth": (3, 4, 5, 6),
    "subsample": (0.5, 0.7, 1.0),
    "colsample_bytree": (0.5, 0.7, 1.0),
}
TREE_GRID = {name: GridAxis(values) for name, values in TREE_VALUES.items()}
TREE_CHOICES = {name: Choice(values) for name, values in TREE_VALUES.items()}
BOOST_GRID = {name: GridAxis(values) for name, values in BOOST_VALUES.items()}

ROWS_PER_TASK = 20_000
"""Training rows in a task of a fit."""

Config = Mapping[str, object]


def objective_score(config: str = "config") -> Column:
    """a^2 + b sin(c) + ln(|d| + 1) e^2 of a config struct."""
    a, b, c, d, e = (F.col(f"{config}.{name}").cast("double") for name in "abcde")
    return a * a + b * F.sin(c) + F.ln(F.abs(d) + 1) * (e * e)


def search_objective(trials: DataFrame, out: str = "score") -> DataFrame:
    return trials.withColumn(out, objective_score())


def as_configs(trials: DataFrame) -> list[dict]:
    """A trial table's configs on the driver, where fits are submitted from."""
    return [row["config"].asDict() for row in trials.orderBy("trial_id").select("config").collect()]


@dataclass(frozen=True)
class ModelSpec:
    """An estimator, the setter values a config maps to, and the metric to judge by.

    ``together`` cross-validates many values at once: rows, the fold's column, the number of folds and the values
    give a metric per value and fold.
    """

    estimator: Estimator
    params: Mapping[str, Param]
    convert: Mapping[str, Mapping]
    evaluator: Evaluator
    metric: str
    together: Callable[[DataFrame, str, int, Sequence[tuple]], np.ndarray] | None = None

    def fitted_values(self, config: Config) -> tuple:
        values = []
        for name in self.params:
            value = self.convert.get(name, {}).get(config[name], config[name])
            values.append(value)
        return tuple(values)

    def param_map(self, values: tuple) -> dict[Param, object]:
        return dict(zip(self.params.values(), values, strict=True))


def tree_spec(features: str = "features", label: str = "label", seed: int = 42) -> ModelSpec:
    """One regression tree with a feature subset per split, judged by mean squared error."""
    tree = RandomForestRegressor(
        featuresCol=features, labelCol=label, numTrees=1, bootstrap=False, seed=seed
    )
    params = {
        "max_depth": tree.maxDepth,
        "min_samples_leaf": tree.minInstancesPerNode,
        "max_features": tree.featureSubsetStrategy,
    }
    return ModelSpec(tree, params, {}, RegressionEvaluator(labelCol=label, metricName="mse"), "mse")


def boost_spec(
    features: str = "features", label: str = "label", seed: int = 42, parallelism: int = 4
) -> ModelSpec:
    """Boosted trees, one binary model per class, judged by accuracy."""
    boost = GBTClassifier(featuresCol=features, labelCol=label, seed=seed)
    model = OneVsRest(
        classifier=boost, featuresCol=features, labelCol=label, parallelism=parallelism
    )
    params = {
        "n_estimators": boost.maxIter,
        "learning_rate": boost.stepSize,
        "max_depth": boost.maxDepth,
        "subsample": boost.subsamplingRate,
        "colsample_bytree": boost.featureSubsetStrategy,
    }
    convert = {"colsample_bytree": {0.5: "0.5", 0.7: "0.7", 1.0: "all"}}
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")

    def together(rows: DataFrame, fold: str, k: int, distinct: Sequence[tuple]) -> np.ndarray:
        shares = {"all": 1.0}
        settings = [boosting.Setting(*values, shares.get(columns) or float(columns)) for *values, columns in distinct]
        return boosting.accuracies(rows, fold, k, settings, features, label, seed)

    return ModelSpec(model, params, convert, judge, "accuracy", together)


def training_rows(df: DataFrame, features: str | Sequence[str], label: str, *keep: str) -> DataFrame:
    """``(features VECTOR, label DOUBLE, keep...)`` from a list column or single columns."""
    xs = F.col(features) if isinstance(features, str) else F.array(*features)
    return df.select(
        array_to_vector(xs.cast("array<double>")).alias("features"),
        F.col(label).cast("double").alias("label"),
        *keep,
    )


def dealt(rows: DataFrame) -> DataFrame:
    """Training rows in one partition per ``ROWS_PER_TASK`` of them, evenly.

    A boosted model takes some fifty stages, and a search many models, so a task for each shuffle
    partition, most of them empty, would cost far more than the rows. They are sorted
    by their hash, so that draws by place agree in reruns. A small table in few partitions is left as
    it is. ``rows`` are read three times, so they should be cached.
    """
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    if count <= ROWS_PER_TASK and rows.rdd.getNumPartitions() <= 2 * cores:
        return rows
    tasks = max(1, math.ceil(count / ROWS_PER_TASK))
    return rows.repartition(tasks).sortWithinPartitions(F.xxhash64(*rows.columns))


def cross_validated(
    rows: DataFrame, fold: str, k: int, configs: Sequence[Config], spec: ModelSpec, parallelism: int = 4
) -> DataFrame:
    """Mean metric over ``k`` folds for every config: ``(trial_id, config, metric)``.

    Each fit is a distributed job over all rows; ``parallelism`` of them are
    under way at a time. ``CrossValidator`` would fit the best config once more on all rows.
    A ``spec`` that can fits all configs in all folds together.
    """
    distinct = list(dict.fromkeys(map(spec.fitted_values, configs)))
    problem = F.raise_error(F.printf(F.lit(f"Fold number must be in range [0, {k}), but got %s"), F.col(fold)))
    known = F.when((F.col(fold) >= 0) & (F.col(fold) < k), F.col(fold)).otherwise(problem)
    rows = rows.withColumn(fold, known).persist(StorageLevel.MEMORY_AND_DISK)
    found = []
    try:
        for i in range(k):
            train, test = rows.where(F.col(fold) != i), rows.where(F.col(fold) == i)
            for part, name in ((train, "training"), (test, "validation")):
                if part.isEmpty():
                    raise ValueError(f"The {name} data at fold {i} is empty.")
            if not spec.together:
                found.append(_scores(dealt(train), dealt(test), distinct, spec, parallelism))
        if spec.together:
            found = [dict(zip(distinct, one, strict=True)) for one in spec.together(rows, fold, k, distinct).T]
    finally:
        rows.unpersist()
    scores = {values: float(np.mean([one[values] for one in found])) for values in distinct}
    return trial_table(rows.sparkSession, configs, scores, spec)


def holdout_scored(
    train: DataFrame, test: DataFrame, configs: Sequence[Config], spec: ModelSpec, parallelism: int = 4
) -> DataFrame:
    """Metric on the test rows for every config: ``(trial_id, config, metric)``."""
    distinct = list(dict.fromkeys(map(spec.fitted_values, configs)))
    scores = _scores(train, test, distinct, spec, parallelism)
    return trial_table(train.sparkSession, configs, scores, spec)


def _scores(
    train: DataFrame, test: DataFrame, distinct: Sequence[tuple], spec: ModelSpec, parallelism: int
) -> dict[tuple, float]:
    train, test = train.persist(), test.persist()
    fits = spec.estimator.fitMultiple(train, [spec.param_map(values) for values in distinct])
    spark = train.sparkSession

    def score_next(_: int) -> tuple[tuple, float]:
        index, model = next(fits)
        return distinct[index], spec.evaluator.evaluate(model.transform(test))

    pool = ThreadPool(processes=min(parallelism, len(distinct)))
    try:
        run = inheritable_thread_target(spark)(partial(score_next))
        return dict(pool.map(run, range(len(distinct)), chunksize=1))
    finally:
        pool.close()
        train.unpersist()
        test.unpersist()


def trial_table(
    spark: SparkSession, configs: Sequence[Config], scores: Mapping[tuple, float], spec: ModelSpec
) -> DataFrame:
    rows = [
        Row(
            trial_id=i,
            config=Row(**config),
            **{spec.metric: float(scores[spec.fitted_values(config)])},
        )
        for i, config in enumerate(configs)
    ]
    return spark.createDataFrame(rows)


def refit(rows: DataFrame, config: Config, spec: ModelSpec):
    """The model of the winning config, fitted on all rows."""
    return spec.estimator.fit(rows, spec.param_map(spec.fitted_values(config)))

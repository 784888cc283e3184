"""Queries on trial generation, splits and search."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import metrics
from tidewheel.functions.rounding import to_places
from tidewheel.operators import fanout, search, trees, trials
from tidewheel.operators.skew import spread
from tidewheel.plans.data import load
from tidewheel.plans.registry import digest_sql, double, query, rank_sql, uniform_sql

_SEED = 7


def _list_sql(values: tuple) -> str:
    return "[" + ", ".join(repr(v) if isinstance(v, (int, str)) else double(v) for v in values) + "]"


def _grid_columns_sql(values: dict[str, tuple], index: str) -> str:
    columns, stride = [], 1
    for name, axis in reversed(values.items()):
        columns.append(f"({_list_sql(axis)})[({index} // {stride}) % {len(axis)} + 1] AS {name}")
        stride *= len(axis)
    return ", ".join(columns)


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """One search per supplier."""
    return spread(load(spark, folder, "supplier").select("s_suppkey"), "s_suppkey")


@query(
    f"""SELECT s_suppkey, i::INT AS config_id, {_grid_columns_sql(search.TREE_VALUES, 'i')}
    FROM supplier, range({math.prod(map(len, search.TREE_VALUES.values()))}) r(i)"""
)
def grid_configs(spark: SparkSession, folder: str) -> DataFrame:
    rows = trials.grid_configs(suppliers(spark, folder), "s_suppkey", search.TREE_GRID)
    return rows.select("s_suppkey", "config_id", "config.*")


@query(
    f"""SELECT s_suppkey, draw::INT AS draw, i::INT AS config_id,
      {_grid_columns_sql(search.BOOST_VALUES, 'i')}
    FROM (SELECT s_suppkey, i, row_number() OVER (PARTITION BY s_suppkey
        ORDER BY {digest_sql(f'{_SEED}:grid', 's_suppkey', 'i')}, i) - 1 AS draw
      FROM supplier, range({math.prod(map(len, search.BOOST_VALUES.values()))}) r(i))
    WHERE draw < 100"""
)
def sample_grid(spark: SparkSession, folder: str) -> DataFrame:
    rows = trials.ranked_grid(
        suppliers(spark, folder), "s_suppkey", search.BOOST_GRID, 100, _SEED
    )
    return rows.select("s_suppkey", "draw", "config_id", "config.*")


@query(
    "SELECT s_suppkey, draw::INT AS draw, "
    + ", ".join(
        f"({_list_sql(values)})[1 + floor({uniform_sql(f'{_SEED}:{name}', 's_suppkey', 'draw')}"
        f" * {len(values)})::INT] AS {name}"
        for name, values in search.TREE_VALUES.items()
    )
    + " FROM supplier, range(210) r(draw)"
)
def sample_choice(spark: SparkSession, folder: str) -> DataFrame:
    rows = trials.sample_choice(
        suppliers(spark, folder), "s_suppkey", search.TREE_CHOICES, 210, _SEED
    )
    return rows.select("s_suppkey", "draw", "config.*")


def _draw_sql(name: str) -> str:
    return uniform_sql(f"{_SEED}:{name}", "trial_id")


_TRIALS_SQL = f"""(SELECT trial_id, o_orderkey, ([0.001, 0.01, 0.1]::DOUBLE[])[g + 1] AS a,
      1 + floor({_draw_sql('b')} * 5)::INT AS b,
      0.0::DOUBLE + {_draw_sql('c')} * {double(4 * math.pi)} AS c,
      exp({double(math.log(1e-5))} + {_draw_sql('d')}
        * {double(math.log(1e3) - math.log(1e-5))}) AS d,
      round(1.0::DOUBLE + {_draw_sql('e')} * 199.0::DOUBLE) AS e
    FROM (SELECT o_orderkey, g, o_orderkey * 3 + g AS trial_id FROM orders, range(3) r(g)))"""

_SCORED_SQL = f"""(SELECT *, a*a + b*sin(c) + ln(abs(d)+1)*(e*e) AS score FROM {_TRIALS_SQL})"""

_CONFIG_SQL = "a, b, round(c, 6) AS c, round(d, 6) AS d, e"


def objective_trials(spark: SparkSession, folder: str) -> DataFrame:
    """Every order is one sample of the space; each sample runs the whole grid axis."""
    samples = spread(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return trials.sample_space(samples, "o_orderkey", search.OBJECTIVE_SPACE, _SEED)


def _flat(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(
        "trial_id",
        "config.a",
        "config.b",
        to_places("config.c", 6).alias("c"),
        to_places("config.d", 6).alias("d"),
        "config.e",
        *(to_places(name, 6).alias(name) for name in more),
    )


@query(f"SELECT trial_id, {_CONFIG_SQL} FROM {_TRIALS_SQL}")
def sample_space(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(objective_trials(spark, folder))


@query(f"SELECT trial_id, {_CONFIG_SQL}, round(score, 6) AS score FROM {_SCORED_SQL}")
def search_objective(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(search.search_objective(objective_trials(spark, folder)), "score")


@query(
    f"""SELECT trial_id, {_CONFIG_SQL}, round(score, 6) AS score FROM {_SCORED_SQL} s
    ORDER BY s.score, trial_id LIMIT 1"""
)
def search_best(spark: SparkSession, folder: str) -> DataFrame:
    scored = search.search_objective(objective_trials(spark, folder))
    return _flat(trials.best_trial(scored, "score", "min"), "score")


def objective(config: dict) -> dict[str, float]:
    """The objective as a plain function of one config."""
    a, b, c, d, e = (config[name] for name in "abcde")
    return {"score": a**2 + b * math.sin(c) + math.log(abs(d) + 1) * e**2}


def objective_of_many(config: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The objective of many configs, a list of values for each name."""
    a, b, c, d, e = (config[name] for name in "abcde")
    return {"score": a**2 + b * np.sin(c) + np.log(np.abs(d) + 1) * e**2}


@query(f"SELECT trial_id, {_CONFIG_SQL}, round(score, 6) AS score FROM {_SCORED_SQL}")
def udf_trial(spark: SparkSession, folder: str) -> DataFrame:
    trials = objective_trials(spark, folder)
    return _flat(fanout.map_trial_batches(trials, objective_of_many, ["score"]), "score")


@query(f"SELECT o_orderkey, {uniform_sql('42', 'o_orderkey')} < 0.2::DOUBLE AS is_test FROM orders")
def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    return trials.holdout_split(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    f"""SELECT o_orderkey, row_number() OVER (ORDER BY {rank_sql('42', 'o_orderkey')}, o_orderkey)
      <= ceil(0.2 * count(*) OVER ()) AS is_test FROM orders"""
)
def holdout_exact(spark: SparkSession, folder: str) -> DataFrame:
    return trials.holdout_exact(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    f"""SELECT event_id, floor({uniform_sql('42:fold', 'event_id')} * 5)::INT AS fold
    FROM events"""
)
def kfold(spark: SparkSession, folder: str) -> DataFrame:
    return trials.kfold(load(spark, folder, "events").select("event_id"), "event_id")


@query(
    """SELECT o_orderkey, o_orderpriority, ((row_number() OVER (PARTITION BY o_orderpriority
      ORDER BY o_orderkey) - 1) % 5)::INT AS fold FROM orders"""
)
def kfold_stratified(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return trials.kfold_stratified(rows, "o_orderpriority", "o_orderkey")


CHARGE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def charges(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a row key and what was charged for them, in thousands."""
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    key = F.concat_ws("-", *keys)
    return spread(load(spark, folder, "lineitem"), *keys).select(
        key.alias("row_key"), *CHARGE_FEATURES, (charge / 1000).alias("charge")
    )


FOLDS = 5
BINS = 32


def tree_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Training rows in five folds, and test rows, with their features in bins."""
    rows = trees.binned(charges(spark, folder), CHARGE_FEATURES, "charge", BINS, "row_key")
    split = trials.kfold(trials.holdout_split(rows, "row_key"), "row_key", FOLDS).drop("row_key")
    return split.where(~F.col("is_test")).drop("is_test"), split.where("is_test").select("bins", "y", F.lit(FOLDS).alias("fold"))


def searched(
    spark: SparkSession, folder: str, drawn: DataFrame, folds: int, judged: bool
) -> DataFrame:
    """The configs (trial_id, config) with ``mse``, and with ``test_mse`` if ``judged``:
    the error on the test rows of a tree on all training rows."""
    train, test = tree_tables(spark, folder)
    configs = search.as_configs(drawn)
    found = trees.search(train, configs, len(CHARGE_FEATURES), BINS, folds, test if judged else None)
    rows = [
        (i, *config.values(), metric, refit)
        for i, (config, metric, refit) in enumerate(zip(configs, found.metrics, found.refit, strict=True))
    ]
    kinds = "max_depth int, min_samples_split int, min_samples_leaf int, max_features string"
    return spark.createDataFrame(rows, f"trial_id int, {kinds}, mse double, test_mse double")


def _grid(spark: SparkSession, **axes: trials.GridAxis) -> DataFrame:
    one_search = spark.range(1).withColumnRenamed("id", "search_id")
    return trials.grid_configs(one_search, "search_id", search.TREE_GRID | axes).withColumnRenamed("config_id", "trial_id")


def _scored(rows: DataFrame) -> DataFrame:
    """With the score that is the better the higher it is."""
    return rows.withColumn("score", metrics.negated(F.col("mse")))


@query()
def cv_grid_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The whole grid by cross-validation on the training rows: 420 configs in 5 folds."""
    scored = _scored(searched(spark, folder, _grid(spark), FOLDS, judged=False)).drop("test_mse")
    return scored.withColumns({name: to_places(name, 4) for name in ("mse", "score")})


@query()
def cv_grid_best(spark: SparkSession, folder: str) -> DataFrame:
    """The config of the highest score in that search, fitted again on all training rows, with
    its error on the test rows."""
    best = trials.best_trial(_scored(searched(spark, folder, _grid(spark), FOLDS, judged=True)), "score", "max")
    return best.withColumns({name: to_places(name, 4) for name in ("mse", "test_mse", "score")})


_STUMP_VALUES = search.TREE_VALUES | {"max_depth": (1,)}


@query(
    f"""WITH charges AS (SELECT {', '.join(CHARGE_FEATURES)},
        l_extendedprice * (1 - l_discount) * (1 + l_tax) / 1000 AS y,
        l_orderkey||'-'||l_partkey||'-'||l_suppkey||'-'||l_linenumber AS row_key FROM lineitem),
      ends AS (SELECT {', '.join(f'min({c}) AS low_{c}, max({c}) AS high_{c}' for c in CHARGE_FEATURES)} FROM charges),
      train AS (SELECT row_number() OVER () AS id, y, floor({uniform_sql('42:fold', 'row_key')} * {FOLDS})::INT AS fold,
        [{', '.join(f'least({BINS - 1}, floor(({c} - low_{c}) / (high_{c} - low_{c}) * {BINS}))::INT' for c in CHARGE_FEATURES)}] AS bins
        FROM charges, ends WHERE {uniform_sql('42', 'row_key')} >= 0.2::DOUBLE),
      tried AS (SELECT f FROM (SELECT f, row_number() OVER (ORDER BY {uniform_sql('42:split', '1', 'f')}, f) AS place
        FROM range({len(CHARGE_FEATURES)}) r(f)) WHERE place <= 2),
      long AS (SELECT id, y, fold, f, bins[f + 1] AS bin FROM train, tried),
      cells AS (SELECT k, f, bin, count(*) AS n, sum(y) AS s FROM long, range({FOLDS}) r(k)
        WHERE fold <> k GROUP BY ALL),
      sides AS (SELECT k, f, bin, sum(n) OVER upto AS n1, sum(s) OVER upto AS s1,
          sum(n) OVER whole AS n, sum(s) OVER whole AS s
        FROM cells WINDOW whole AS (PARTITION BY k, f),
          upto AS (PARTITION BY k, f ORDER BY bin ROWS UNBOUNDED PRECEDING)),
      splits AS (SELECT *, s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) - s * s / n AS gain
        FROM sides, (SELECT unnest({list(search.TREE_VALUES['min_samples_leaf'])}) AS leaf)
        WHERE n1 >= leaf AND n - n1 >= leaf AND n > n1),
      best AS (SELECT * FROM splits
        QUALIFY row_number() OVER (PARTITION BY k, leaf ORDER BY gain DESC, f, bin) = 1),
      errors AS (SELECT leaf, k, avg(pow(CASE WHEN l.bin <= b.bin THEN s1 / n1
          ELSE (s - s1) / (n - n1) END - y, 2)) AS mse
        FROM best b JOIN long l ON l.fold = b.k AND l.f = b.f GROUP BY ALL),
      means AS (SELECT leaf, avg(mse) AS mse FROM errors GROUP BY leaf),
      grid AS (SELECT i::INT AS trial_id, {_grid_columns_sql(_STUMP_VALUES, 'i')}
        FROM range({math.prod(map(len, _STUMP_VALUES.values()))}) r(i))
    SELECT trial_id, max_depth, min_samples_split, min_samples_leaf, max_features,
      round(mse, 4) AS mse, round(-mse, 4) AS score
    FROM grid JOIN means ON min_samples_leaf = leaf"""
)
def cv_grid_stump(spark: SparkSession, folder: str) -> DataFrame:
    """The grid of that search at depth one: 60 configs in 5 folds."""
    grid = _grid(spark, max_depth=trials.GridAxis((1,)))
    scored = _scored(searched(spark, folder, grid, FOLDS, judged=False)).drop("test_mse")
    return scored.withColumns({name: to_places(name, 4) for name in ("mse", "score")})


def _drawn(spark: SparkSession) -> DataFrame:
    one_search = spark.range(1).withColumnRenamed("id", "search_id")
    return trials.sample_choice(one_search, "search_id", search.TREE_CHOICES, 210, _SEED).withColumnRenamed("draw", "trial_id")


@query()
def holdout_search_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Search of a tree over 210 independent draws, judged on the test rows."""
    rows = searched(spark, folder, _drawn(spark), 0, judged=True).drop("mse").withColumnRenamed("test_mse", "mse")
    return rows.withColumn("mse", to_places("mse", 4))


@query()
def holdout_search_best(spark: SparkSession, folder: str) -> DataFrame:
    """The winner of that search and its config."""
    rows = searched(spark, folder, _drawn(spark), 0, judged=True).drop("mse").withColumnRenamed("test_mse", "mse")
    return trials.best_trial(rows, "mse", "min").withColumn("mse", to_places("mse", 4))


@query()
def cv_random_boost(spark: SparkSession, folder: str) -> DataFrame:
    """Randomised search of boosted trees: 100 draws from the whole space in 5 folds; the class
    is the largest of ten dimensions."""
    head = F.slice("embedding", 1, 10)
    label = (F.array_position(head, F.array_max(head)) - 1).cast("int")
    rows = load(spark, folder, "embeddings").withColumn("class", label)
    rows = trials.kfold_stratified(rows, "class", "vec_id", FOLDS)
    one_search = spark.range(1).withColumnRenamed("id", "search_id")
    draws = trials.sample_grid(one_search, "search_id", search.BOOST_GRID, 100, _SEED)
    configs = search.as_configs(draws.withColumnRenamed("draw", "trial_id"))
    train = search.training_rows(rows, "embedding", "class", "fold")
    scored = search.cross_validated(train, "fold", FOLDS, configs, search.boost_spec())
    return scored.select("trial_id", "config.*", to_places("accuracy", 4).alias("accuracy"))

"""Queries on scaling, scores, quality measures and functions fanned out over lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import metrics
from tidewheel.functions.arrays import total
from tidewheel.functions.rounding import to_places
from tidewheel.operators import fanout, reshape, scale
from tidewheel.operators.trials import best_trial as best_of
from tidewheel.plans.data import load
from tidewheel.plans.registry import query

_LISTS = "(SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)"

_MINMAX_ARRAY_SQL = f"""SELECT vec_id, (i-1)::INT AS pos,
      round((e[i]-list_min(e))/(list_max(e)-list_min(e)), 6) AS x
    FROM {_LISTS}, range(1, 65) r(i)"""


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("xs")
    )


def values_by_user(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select("event_id", "user_id", "value")


@query(_MINMAX_ARRAY_SQL)
def minmax_array(spark: SparkSession, folder: str) -> DataFrame:
    scaled = scale.minmax_array(vectors(spark, folder), "xs")
    rows = reshape.explode_list(scaled, ["vec_id"], "scaled")
    return rows.withColumn("x", to_places("x", 6))


@query(
    """SELECT event_id, user_id, round((value - min(value) OVER w)
      / (max(value) OVER w - min(value) OVER w), 6) AS scaled
    FROM events WINDOW w AS (PARTITION BY user_id)"""
)
def minmax_group(spark: SparkSession, folder: str) -> DataFrame:
    scaled = scale.minmax_group(values_by_user(spark, folder), ["user_id"], "value")
    return scaled.select("event_id", "user_id", to_places("scaled", 6).alias("scaled"))


@query(
    """SELECT event_id, user_id, round((value - avg(value) OVER w)
      / stddev_pop(value) OVER w, 6) AS scaled
    FROM events WINDOW w AS (PARTITION BY user_id)"""
)
def zscore_group(spark: SparkSession, folder: str) -> DataFrame:
    scaled = scale.zscore_group(values_by_user(spark, folder), ["user_id"], "value")
    return scaled.select("event_id", "user_id", to_places("scaled", 6).alias("scaled"))


@query(
    """SELECT event_id, user_id, round((value - avg(value) OVER w) / stddev_pop(value) OVER w, 6)
      AS standard, round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w), 6)
      AS unit, round((value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) * 2 - 1,
      6) AS symmetric
    FROM events WINDOW w AS (PARTITION BY user_id)"""
)
def scale_multi(spark: SparkSession, folder: str) -> DataFrame:
    outputs = {"standard": "standard", "unit": (0.0, 1.0), "symmetric": (-1.0, 1.0)}
    scaled = scale.scale_groups(values_by_user(spark, folder), ["user_id"], "value", outputs)
    return scaled.select("event_id", "user_id", *(to_places(n, 6).alias(n) for n in outputs))


_MATRIX = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "SELECT l_orderkey, l_partkey, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in _MATRIX)
    + " FROM lineitem"
)
def standardize_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", *_MATRIX)
    scaled = scale.standardize_matrix(rows, _MATRIX)
    return scaled.withColumns({name: to_places(name, 6) for name in _MATRIX})


@query("SELECT user_id, round(avg(value), 6) AS score FROM events GROUP BY 1")
def mean_score(spark: SparkSession, folder: str) -> DataFrame:
    scores = scale.mean_score(load(spark, folder, "events"), ["user_id"], "value")
    return scores.withColumn("score", to_places("score", 6))


@query(
    """SELECT l_returnflag, round(avg(pow(l_discount - l_tax, 2)), 8) AS mse
    FROM lineitem GROUP BY 1"""
)
def mse(spark: SparkSession, folder: str) -> DataFrame:
    error = metrics.mse(F.col("l_discount"), F.col("l_tax"))
    return load(spark, folder, "lineitem").groupBy("l_returnflag").agg(to_places(error, 8).alias("mse"))


@query(
    """SELECT count(*) AS n_rows, round(avg((list_position(p, list_max(p)) - 1 = label)::INT), 8)
      AS accuracy, round(-avg(ln(p[label + 1])), 6) AS log_loss
    FROM (SELECT label, list_transform(z, lambda x: x / list_sum(z)) AS p
      FROM (SELECT label, list_transform(embedding[1:10]::DOUBLE[], lambda x: exp(x)) AS z
        FROM embeddings))"""
)
def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten dimensions taken as the scores of the ten classes."""
    scores = F.slice(F.col("embedding").cast("array<double>"), 1, 10)
    rows = load(spark, folder, "embeddings").select("label", F.transform(scores, F.exp).alias("z"))
    rows = rows.withColumn("__sum", total(F.col("z")))
    rows = rows.select("label", F.transform("z", lambda x: x / F.col("__sum")).alias("p"))
    predicted = F.array_position("p", F.array_max("p")) - 1
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        to_places(metrics.accuracy(F.col("label"), predicted), 8).alias("accuracy"),
        to_places(metrics.log_loss(F.col("p"), F.col("label")), 6).alias("log_loss"),
    )


def _best_sql(mode: str, order: str) -> str:
    return f"""(SELECT '{mode}' AS mode, o_orderpriority AS priority, o_orderkey AS trial_id,
      o_custkey AS custkey, o_totalprice AS metric FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY {order}) = 1)"""


@query(
    _best_sql("min", "o_totalprice, o_orderkey")
    + " UNION ALL "
    + _best_sql("max", "o_totalprice DESC, o_orderkey")
)
def best_trial(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as trials: the cheapest and the dearest per priority, with their configs."""
    trials = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("trial_id"),
        F.struct(
            F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("custkey")
        ).alias("config"),
        F.col("o_totalprice").alias("metric"),
        F.col("o_orderpriority").alias("search"),
    )
    best = [
        best_of(trials, "metric", mode, by=["search"]).withColumn("mode", F.lit(mode))
        for mode in ("min", "max")
    ]
    return best[0].unionByName(best[1]).select("mode", "config.*", "trial_id", "metric")


@query(f"SELECT vec_id, round(list_avg(e), 6) AS score FROM {_LISTS}")
def udf_score(spark: SparkSession, folder: str) -> DataFrame:
    score = fanout.score_lists(F.col("xs"), lambda xs: float(xs.mean()) if len(xs) else None)
    return vectors(spark, folder).select("vec_id", to_places(score, 6).alias("score"))


def _unit_range(xs: np.ndarray) -> np.ndarray:
    return fanout.ListProcessor(xs).minmax()


@query(_MINMAX_ARRAY_SQL)
def udf_scale(spark: SparkSession, folder: str) -> DataFrame:
    scaled = vectors(spark, folder).select(
        "vec_id", fanout.map_lists(F.col("xs"), _unit_range).alias("scaled")
    )
    rows = reshape.explode_list(scaled, ["vec_id"], "scaled")
    return rows.withColumn("x", to_places("x", 6))


@query(
    f"""SELECT vec_id, (i-1)::INT AS pos,
      round((e[i]-list_avg(e))/list_stddev_pop(e), 6) AS standard,
      round((e[i]-list_min(e))/(list_max(e)-list_min(e)), 6) AS minmax
    FROM {_LISTS}, range(1, 65) r(i)"""
)
def udf_processor(spark: SparkSession, folder: str) -> DataFrame:
    processed = fanout.process_lists(F.col("xs"), ["standard", "minmax"])
    lists = vectors(spark, folder).select("vec_id", processed.alias("both"))
    zipped = F.arrays_zip("both.standard", "both.minmax")
    rows = lists.select("vec_id", F.posexplode(zipped).alias("pos", "pair"))
    return rows.select(
        "vec_id",
        "pos",
        to_places("pair.standard", 6).alias("standard"),
        to_places("pair.minmax", 6).alias("minmax"),
    )


@query("SELECT event_type, user_id, round(avg(value), 6) AS mean FROM events GROUP BY 1, 2")
def udaf_mean(spark: SparkSession, folder: str) -> DataFrame:
    means = fanout.mean_by_batches(
        load(spark, folder, "events"), ["event_type", "user_id"], "value"
    )
    return means.withColumn("mean", to_places("mean", 6))

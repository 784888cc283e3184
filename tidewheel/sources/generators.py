"""Seeded data made from the keys of a table; the output grows with that table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.arrays import dot
from tidewheel.functions.keyed import keyed_int, keyed_normal, keyed_uniform


def generate_lists(
    ids: DataFrame, key: str, size: int, low: int = 1, high: int = 100, seed: int = 0
) -> DataFrame:
    """For each key a list of ``size`` integers in ``low..high`` as ``(list_id, pos, x)``."""
    places = F.explode(F.sequence(F.lit(1), F.lit(size))).alias("pos")
    return ids.select(F.col(key).alias("__key"), places).select(
        F.concat(F.lit("list_"), F.col("__key").cast("string")).alias("list_id"),
        "pos",
        keyed_int(low, high, f"{seed}:list", "__key", "pos").alias("x"),
    )


def generate_walks(
    ids: DataFrame, key: str, steps: int, drift: Column, seed: int = 42
) -> DataFrame:
    """Random walks: running sums of ``steps`` standard normals plus ``drift``.

    Each series has exactly ``steps`` rows, so a plain window per series is even.
    """
    moves = ids.select(
        F.col(key).alias("series"),
        drift.cast("double").alias("__drift"),
        F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("t"),
    ).withColumn("__move", keyed_normal(f"{seed}:walk", "series", "t") + F.col("__drift"))
    so_far = (
        Window.partitionBy("series")
        .orderBy("t")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return moves.select("series", "t", F.sum("__move").over(so_far).alias("y"))


def regression_weights(n_features: int, n_informative: int, seed: int) -> list[Column]:
    """Weights uniform in 0..100 for the informative features and 0 for the others."""
    return [
        F.lit(100.0) * keyed_uniform(f"{seed}:weight", F.lit(j)) if j < n_informative else F.lit(0.0)
        for j in range(n_features)
    ]


def generate_regression(
    ids: DataFrame,
    key: str,
    n_features: int,
    noise: float = 0.1,
    n_informative: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Per key ``n_features`` normals ``f0..`` and a noisy linear target ``y``."""
    names = [f"f{j}" for j in range(n_features)]
    features = [
        keyed_normal(f"{seed}:f{j}", key).alias(name) for j, name in enumerate(names)
    ]
    error = F.lit(noise) * keyed_normal(f"{seed}:noise", key)
    weights = F.array(*regression_weights(n_features, n_informative, seed))
    rows = ids.select(key, *features, error.alias("__error"))
    return rows.select(
        key, *names, (dot(F.array(*names), weights) + F.col("__error")).alias("y")
    )

"""Trials of a search space, the split of rows into train, test and folds, the best trial.

Trials are rows, made by exploding an index per id and decoding it; no join is
involved and nothing is drawn on the driver.
"""

from __future__ import annotations

import math
from abc import ABC, abstractmethod
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.keyed import digest, keyed_bits, keyed_rank, keyed_uniform
from tidewheel.operators.ordering import Layout, ordinal
from tidewheel.operators.selection import first_k


@dataclass(frozen=True)
class GridAxis:
    """Every value is tried; axes multiply."""

    values: tuple

    def at(self, index: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.values)), index.cast("int") + 1)


class Sampler(ABC):
    """Maps a uniform draw in [0, 1) to a value."""

    @abstractmethod
    def draw(self, u: Column) -> Column: ...


@dataclass(frozen=True)
class Choice(Sampler):
    values: tuple

    def draw(self, u: Column) -> Column:
        index = F.floor(u * F.lit(len(self.values))).cast("int") + 1
        return F.element_at(F.array(*map(F.lit, self.values)), index)


@dataclass(frozen=True)
class Uniform(Sampler):
    low: float
    high: float

    def draw(self, u: Column) -> Column:
        return F.lit(float(self.low)) + u * F.lit(float(self.high - self.low))


@dataclass(frozen=True)
class LogUniform(Sampler):
    low: float
    high: float

    def draw(self, u: Column) -> Column:
        return F.exp(Uniform(math.log(self.low), math.log(self.high)).draw(u))


@dataclass(frozen=True)
class QUniform(Sampler):
    """Uniform, rounded to a multiple of ``step``."""

    low: float
    high: float
    step: float

    def draw(self, u: Column) -> Column:
        step = F.lit(float(self.step))
        return F.round(Uniform(self.low, self.high).draw(u) / step) * step


Space = Mapping[str, GridAxis | Sampler]


def grid_size(space: Space) -> int:
    return math.prod(len(axis.values) for axis in space.values() if isinstance(axis, GridAxis))


def decode_grid(space: Space, index: Column) -> dict[str, Column]:
    """The grid axes' values for configuration ``index``; the last axis changes fastest."""
    values, stride = {}, 1
    for name, axis in reversed(space.items()):
        if isinstance(axis, GridAxis):
            digit = F.floor(index / F.lit(stride)) % F.lit(len(axis.values))
            values[name] = axis.at(digit)
            stride *= len(axis.values)
    return values


def grid_configs(searches: DataFrame, key: str, space: Space) -> DataFrame:
    """The full grid for every search: ``(key, config_id, config)``."""
    last = F.lit(grid_size(space) - 1)
    rows = searches.select(key, F.explode(F.sequence(F.lit(0), last)).alias("config_id"))
    return rows.withColumn("config", _config(space, decode_grid(space, F.col("config_id"))))


def sample_space(samples: DataFrame, key: str, space: Space, seed: int = 0) -> DataFrame:
    """Trials ``(trial_id, key, config)``: the grid axes repeated for every sample.

    The other axes are drawn afresh for each trial, keyed by the trial id.
    ``key`` must be a non-negative integer.
    """
    size = grid_size(space)
    rows = samples.select(
        key, F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("__grid")
    ).withColumn("trial_id", F.col(key) * F.lit(size) + F.col("__grid"))
    values = decode_grid(space, F.col("__grid"))
    for name, axis in space.items():
        if isinstance(axis, Sampler):
            values[name] = axis.draw(keyed_uniform(f"{seed}:{name}", "trial_id"))
    return rows.select("trial_id", key, _config(space, values).alias("config"))


def sample_choice(
    searches: DataFrame, key: str, space: Space, n: int, seed: int = 0
) -> DataFrame:
    """``n`` independent draws per search, repeats allowed."""
    draws = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("draw")
    values = {
        name: axis.draw(keyed_uniform(f"{seed}:{name}", key, "draw"))
        for name, axis in space.items()
    }
    return searches.select(key, draws).withColumn("config", _config(space, values))


ROUNDS = 4


def factors(size: int) -> tuple[int, int]:
    """Two factors of ``size``, as close to each other as there are."""
    low = math.isqrt(size)
    while low > 1 and size % low:
        low -= 1
    return max(low, 1), size // max(low, 1)


def permuted(index: Column, size: int, tag: str, *ids: str) -> Column:
    """The place of ``index`` in a keyed shuffle of 0 to ``size`` - 1, without the others.

    The index is taken apart into a quotient and a remainder by a factor of ``size``, and in
    turn each is moved on by a hash of the other, as in a Feistel network; so no two indices
    come to the same place. A ``size`` that is prime is only turned round and stretched.
    """
    rows, columns = factors(size)
    index = index.cast("bigint")
    if rows == 1:
        stretch = 1 + keyed_bits(f"{tag}:stretch", *ids) % F.lit(max(size - 1, 1))
        return (index * stretch + keyed_bits(f"{tag}:turn", *ids)) % F.lit(size)
    high, low = F.floor(index / F.lit(columns)).cast("bigint"), index % F.lit(columns)
    for number in range(ROUNDS):
        high = (high + keyed_bits(f"{tag}:{number}:high", *ids, low)) % F.lit(rows)
        low = (low + keyed_bits(f"{tag}:{number}:low", *ids, high)) % F.lit(columns)
    return high * F.lit(columns) + low


def sample_grid(
    searches: DataFrame, key: str, space: Space, n: int, seed: int = 0
) -> DataFrame:
    """``n`` different configurations per search, drawn from the grid without repeats.

    Draw i is the configuration at place i of a keyed shuffle of the grid, which is worked out
    for that place alone; the grid is never laid out, whatever its size.
    """
    size = grid_size(space)
    rows = searches.select(key, F.explode(F.sequence(F.lit(0), F.lit(min(n, size) - 1))).alias("draw"))
    rows = rows.withColumn("config_id", permuted(F.col("draw"), size, f"{seed}:grid", key))
    return rows.withColumn("config", _config(space, decode_grid(space, F.col("config_id"))))


def ranked_grid(
    searches: DataFrame, key: str, space: Space, n: int, seed: int = 0
) -> DataFrame:
    """The first ``n`` configurations per search when its whole grid is ranked by hash.

    Every configuration of every search gets a rank, inside the row, so there is no shuffle; for
    grids that can be laid out. ``sample_grid`` draws from larger ones.
    """
    indices = F.sequence(F.lit(0), F.lit(grid_size(space) - 1))
    ranked = F.transform(
        indices,
        lambda i: F.struct(digest(f"{seed}:grid", [key, i]).alias("rank"), i.alias("config_id")),
    )
    chosen = F.slice(F.array_sort(ranked), 1, n)
    rows = searches.select(key, F.posexplode(chosen).alias("draw", "__pick"))
    rows = rows.select(key, "draw", F.col("__pick.config_id").alias("config_id"))
    return rows.withColumn("config", _config(space, decode_grid(space, F.col("config_id"))))


def _config(space: Space, values: Mapping[str, Column]) -> Column:
    return F.struct(*(values[name].alias(name) for name in space))


def best_trial(
    trials: DataFrame, metric: str, mode: str = "min", by: Sequence[str] = (), trial: str = "trial_id"
) -> DataFrame:
    """The whole row of the best trial, per ``by``; the smaller trial id wins a tie.

    Without ``by`` each partition keeps one row and the driver the best of these. With it, an
    aggregation with a partial step. So there is no global sort and no hot
    task. Trials without a usable metric are passed over in the end or inside the aggregate: a
    filter would make the metric's expression run a second time.
    """
    if mode not in ("min", "max"):
        raise ValueError("mode is 'min' or 'max'")
    row = F.struct(*trials.columns)
    value = F.col(metric)
    usable = value.isNotNull() & ~F.isnan(value.cast("double"))
    if not by:
        ranked = trials.withColumn("__usable", usable)
        sign = value.asc() if mode == "min" else value.desc()
        return ranked.orderBy(F.desc("__usable"), sign, trial).limit(1).where("__usable").drop("__usable")
    if mode == "min":
        best = F.min_by(row, F.when(usable, F.struct(value, F.col(trial))))
    else:
        best = F.max_by(row, F.when(usable, F.struct(value, -F.col(trial))))
    found = trials.groupBy(*by).agg(best.alias("__best"))
    return found.where("__best IS NOT NULL").select("__best.*")


def holdout_split(
    df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Mark about ``fraction`` of the rows as test rows; decided row by row."""
    return df.withColumn(out, keyed_uniform(seed, key) < F.lit(fraction))


def holdout_exact(
    df: DataFrame, key: str, fraction: float = 0.2, seed: int = 42, out: str = "is_test"
) -> DataFrame:
    """Mark exactly ceil(fraction * rows) rows as test rows; ``key`` is a unique integer."""
    wanted = math.ceil(round(fraction * df.count(), 9))
    rank = keyed_rank(seed, key)
    is_test = first_k(df, rank, wanted, tiebreak=F.col(key), bounds=(0, 2**60 - 1))
    return df.withColumn(out, is_test)


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold number from the row's key; folds are even in expectation."""
    return df.withColumn(out, F.floor(keyed_uniform(f"{seed}:fold", key) * F.lit(k)).cast("int"))


def kfold_stratified(
    df: DataFrame,
    label: str,
    order: str,
    k: int = 5,
    out: str = "fold",
    layout: Layout = Layout(),
) -> DataFrame:
    """Deal the rows of each label over the folds in turn, in ``order``."""
    dealt = ordinal(df, [label], [order], "__place", layout)
    return dealt.withColumn(out, ((F.col("__place") - 1) % F.lit(k)).cast("int")).drop("__place")

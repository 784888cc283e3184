"""Per-key statistics joined back to rows when one key may hold most of the rows.

A window over ``partitionBy(key)`` sends a whole group to one task. Here the
statistics come from a partially aggregated ``groupBy`` and travel to the rows:
by broadcast for the hot keys, whose number is bounded because shares add up to
one, and by an ordinary equi-join for all the others.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1e-5
"""A key with at least this share of all rows is hot; at most 1 / HOT_SHARE keys are."""

HOT_ROWS = 1_000_000
"""Groups below this many rows are never hot: one task handles them."""

_COUNT = "__n"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A scanned table with at least one partition per core, split by its unique ``keys``.

    For work that costs far more than moving its input, such as expanding every
    key into thousands of rows: a table in few files would keep most cores idle.
    Tables in many files, as on a cluster, are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT))


def is_hot(counts: DataFrame, hot_share: float, hot_rows: int) -> Column:
    """Predicate on ``counts``; the total is a scalar subquery, not a join."""
    total = counts.agg(F.sum(_COUNT).alias("total")).scalar()
    return F.col(_COUNT) >= F.greatest(total * F.lit(hot_share), F.lit(float(hot_rows)))


def same_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` with their ``__key_*`` copies in ``other``."""
    return reduce(
        lambda left, right: left & right,
        [df[key].eqNullSafe(other[f"__key_{key}"]) for key in keys],
    )


def copy_keys(keys: Sequence[str]) -> list[Column]:
    return [F.col(key).alias(f"__key_{key}") for key in keys]


def drop_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.drop(*(f"__key_{key}" for key in keys))


def attach_stats(
    df: DataFrame,
    keys: Sequence[str],
    stats: Sequence[Column],
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``df`` with the aliased aggregates ``stats`` of its group added to each row.

    Rows of hot keys meet their statistics by broadcast and are never shuffled.
    The rest has no group above the hot size, so its join partitions stay even.
    An ``df`` that is costly to compute should be checkpointed by the caller: it
    is read once for the statistics and once per branch.
    """
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(_COUNT), *stats)
    names = [name for name in grouped.columns if name not in keys and name != _COUNT]
    table = grouped.select(*copy_keys(keys), _COUNT, *names)
    hot_test = is_hot(table, hot_share, hot_rows)
    hot = F.broadcast(table.where(hot_test).drop(_COUNT))
    cold = table.where(~hot_test).drop(_COUNT)
    hot_keys = F.broadcast(table.where(hot_test).select(*(f"__key_{key}" for key in keys)))

    from_hot = df.join(hot, same_keys(df, hot, keys))
    rest = df.join(hot_keys, same_keys(df, hot_keys, keys), "left_anti")
    from_cold = rest.join(cold, same_keys(rest, cold, keys))
    return drop_copies(from_hot, keys).unionByName(drop_copies(from_cold, keys))

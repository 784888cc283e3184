"""Running sums, differences and positions inside ordered groups of any size.

All rows, in the order of keys and order columns, are cut into chunks of about equal size
at splitters taken from a sample, and a chunk's part of a group is a window partition of its
own. Only a group that a splitter falls into lies in several chunks; there are no more of
them than splitters. What a chunk has to know of such a group's rows before it enters its window as
one more row, the seed, which sorts first and is dropped again: rows and seeds share
one shuffle and nothing is joined back.

Order columns are of any type that sorts, as many as it takes to tell the rows of a group
apart. Counting and sampling run when the operator is applied; a table that is costly to
compute should be written or checkpointed before.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

_CHUNK, _CUT, _SEED, _STATE = "__chunk", "__cut", "__seed", "__state"
SAMPLED_PER_CHUNK = 32
MOST_SAMPLED = 1_000_000
"""Rows that splitters are chosen from, as many as Spark itself takes for a sort at most."""


@dataclass(frozen=True)
class Layout:
    """How rows are cut; tests lower the size to have many chunks."""

    rows_per_chunk: int = 5_000_000


@dataclass(frozen=True)
class _Chunks:
    """A table with its chunk numbers; ``cut`` tells whether there are several."""

    rows: DataFrame
    keys: Sequence[str]
    order: Sequence[str]
    cut: bool

    def window(self) -> WindowSpec:
        if not self.cut:
            return Window.partitionBy(*self.keys).orderBy(*self.order)
        return Window.partitionBy(*self.keys, _CHUNK).orderBy(F.col(_SEED).desc(), *self.order)

    def seeded(self, part: Column, state: Callable[[Column, WindowSpec], Column]) -> DataFrame:
        """The rows and, for each later chunk of a group, a row holding its ``state``.

        ``part`` sums up one chunk of a group; ``state`` is taken over the parts of a group
        in chunk order, a window of as many rows as the group has chunks.
        """
        if not self.cut:
            return self.rows
        parts = self.rows.where(_CUT).groupBy(*self.keys, _CHUNK).agg(part.alias("__part"))
        chunks = Window.partitionBy(*self.keys).orderBy(_CHUNK)
        seeds = parts.select(
            *self.keys,
            _CHUNK,
            state(F.col("__part"), chunks).alias(_STATE),
            F.lit(True).alias(_SEED),
        ).where(F.col(_STATE).isNotNull())
        rows = self.rows.withColumn(_SEED, F.lit(False))
        return rows.unionByName(seeds, allowMissingColumns=True)

    def finish(self, result: DataFrame) -> DataFrame:
        return result.where(~F.col(_SEED)).drop(_SEED, _STATE) if self.cut else result


def _columns(keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """Keys, then the order columns that are no keys."""
    return list(dict.fromkeys([*keys, *order]))


def _splitters(df: DataFrame, keys: Sequence[str], order: Sequence[str], layout: Layout) -> DataFrame | None:
    """One row with the sorted array of splitters, each the keys and order columns of a row."""
    total = df.count()
    chunks = math.ceil(total / layout.rows_per_chunk)
    if not keys and total:
        chunks = max(chunks, df.sparkSession.sparkContext.defaultParallelism)
    if chunks < 2:
        return None
    share = min(1.0, min(SAMPLED_PER_CHUNK * chunks, MOST_SAMPLED) / total)
    some = df.select(F.struct(*_columns(keys, order)).alias("row"))
    # a small table is not sampled but sorted, so that its chunks are even
    some = some.sample(share, 17) if total > 100_000 else some
    held = some.agg(F.sort_array(F.collect_list("row")).alias("held"))
    last = F.size("held") - 1
    place = lambda i: F.floor(last * i / chunks).cast("int")
    chosen = F.transform(F.sequence(F.lit(1), F.lit(chunks - 1)), lambda i: F.get(F.col("held"), place(i)))
    one = held.select(F.when(last >= 0, F.array_distinct(chosen)).alias("splitters"))
    # as values: a sample that is taken twice may not be the same
    found = one.first()["splitters"]
    return df.sparkSession.createDataFrame([(found,)], one.schema) if found else None


def _up_to(entries: Column, size: int, row: Column) -> Column:
    """How many of the sorted ``entries`` are not above ``row``, by bisection."""
    steps = [1 << bit for bit in range(size.bit_length() - 1, -1, -1)]

    def step(found: Column, width: Column) -> Column:
        return F.when((found + width <= size) & (F.get(entries, found + width - 1) <= row), found + width).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], layout: Layout) -> _Chunks:
    """Number the chunks; numbers grow with ``order`` inside a group."""
    splitters = _splitters(df, keys, order, layout)
    if splitters is None:
        return _Chunks(df, keys, order, cut=False)
    size = splitters.select(F.size("splitters")).first()[0]
    # in a column first: a subquery cannot stand inside a higher-order function
    rows = df.withColumn("__splitters", splitters.scalar())
    rows = rows.withColumn(_CHUNK, _up_to(F.col("__splitters"), size, F.struct(*_columns(keys, order)))).drop("__splitters")
    if not keys:
        return _Chunks(rows.withColumn(_CUT, F.lit(True)), keys, order, cut=True)
    groups = splitters.select(
        F.array_distinct(F.transform("splitters", lambda x: F.struct(*(x[key].alias(key) for key in keys)))).alias("groups")
    )
    count, key = groups.select(F.size("groups")).first()[0], F.struct(*keys)
    nearest = F.get("__groups", _up_to(F.col("__groups"), count, key) - 1)
    rows = rows.withColumn("__groups", groups.scalar()).withColumn(_CUT, nearest.eqNullSafe(key)).drop("__groups")
    return _Chunks(rows, keys, order, cut=True)


def _earlier_sum(part: Column, chunks: WindowSpec) -> Column:
    return F.sum(part).over(chunks.rowsBetween(Window.unboundedPreceding, -1))


def _earlier_last(part: Column, chunks: WindowSpec) -> Column:
    return F.lag(part).over(chunks)


def _so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str = "running_sum",
    layout: Layout = Layout(),
) -> DataFrame:
    """Sum of ``value`` over the group's rows up to and including this one."""
    chunks = _chunked(df, keys, order, layout)
    rows = chunks.seeded(F.sum(value), _earlier_sum)
    term = F.coalesce(_STATE, value) if chunks.cut else F.col(value)
    summed = rows.withColumn(out, F.sum(term).over(_so_far(chunks.window())))
    return chunks.finish(summed).drop(_CHUNK, _CUT)


def ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "ordinal",
    layout: Layout = Layout(),
) -> DataFrame:
    """Position of the row in its group, counted from 1."""
    chunks = _chunked(df, keys, order, layout)
    rows = chunks.seeded(F.count(F.lit(1)), _earlier_sum)
    if chunks.cut:
        place = F.sum(F.coalesce(_STATE, F.lit(1))).over(_so_far(chunks.window()))
    else:
        place = F.row_number().over(chunks.window()).cast("bigint")
    return chunks.finish(rows.withColumn(out, place)).drop(_CHUNK, _CUT)


def difference(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    times: int = 1,
    out: str = "difference",
    layout: Layout = Layout(),
) -> DataFrame:
    """``value`` minus the one before it in the group, applied ``times`` times."""
    chunks = _chunked(df, keys, order, layout)
    rows = chunks.rows.withColumn(out, F.col(value))
    for _ in range(times):
        chunks = _Chunks(rows, keys, order, chunks.cut)
        seeded = chunks.seeded(F.max_by(out, F.struct(*order)), _earlier_last)
        current = F.coalesce(_STATE, out) if chunks.cut else F.col(out)
        moved = seeded.withColumn(out, current - F.lag(current).over(chunks.window()))
        rows = chunks.finish(moved)
    return rows.drop(_CHUNK, _CUT)


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows; a per-partition top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def slice_first(df: DataFrame, order: Sequence[str], array: str, n: int = 5) -> DataFrame:
    """The first ``n`` elements of the first row's list."""
    return head_rows(df, order, 1).withColumn(array, F.slice(array, 1, n))

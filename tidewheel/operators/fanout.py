"""Python functions and classes applied to lists, trials and groups in Arrow batches.

The functions see one list, one config or one batch at a time; Spark holds the
rows and decides where they run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _items(column: pa.Array) -> Iterator[np.ndarray | None]:
    for item in column:
        yield item.values.to_numpy(zero_copy_only=False) if item.is_valid else None


def _with_nulls(found: Sequence[float], given: pa.ListScalar) -> Sequence[float | None]:
    """``found`` with null where the given list of the same length has a null item."""
    if not given.values.null_count or len(found) != len(given.values):
        return found
    return [x if known else None for x, known in zip(found, given.values.is_valid().to_pylist(), strict=True)]


def score_lists(array: Column, score: Callable[[np.ndarray], float | None]) -> Column:
    """One number per list; null items reach ``score`` as NaN."""

    @F.arrow_udf("double")
    def apply(lists: pa.Array) -> pa.Array:
        return pa.array([None if x is None else score(x) for x in _items(lists)], pa.float64())

    return apply(array)


def map_lists(array: Column, change: Callable[[np.ndarray], Sequence[float]]) -> Column:
    """One list per list; null items reach ``change`` as NaN and come back as null."""

    @F.arrow_udf("array<double>")
    def apply(lists: pa.Array) -> pa.Array:
        return pa.array(
            [
                None if x is None else _with_nulls(change(x), given)
                for x, given in zip(_items(lists), lists, strict=True)
            ],
            pa.list_(pa.float64()),
        )

    return apply(array)


class ListProcessor:
    """Holds one list and scales it on request; NaN items take no part."""

    def __init__(self, data: np.ndarray) -> None:
        self.data = data

    def standard(self) -> np.ndarray:
        known = self.data[~np.isnan(self.data)]
        deviation = known.std() if len(known) else 0.0
        return (self.data - known.mean()) / deviation if deviation > 0 else np.zeros(len(self.data))

    def minmax(self) -> np.ndarray:
        known = self.data[~np.isnan(self.data)]
        low, high = (known.min(), known.max()) if len(known) else (0.0, 0.0)
        return (self.data - low) / (high - low) if high > low else np.zeros(len(self.data))


def process_lists(
    array: Column, methods: Sequence[str], processor: type = ListProcessor
) -> Column:
    """One processor per list, several of its methods called; a struct of their results.

    Null items reach the processor as NaN and come back as null.
    """
    result = ", ".join(f"{method} array<double>" for method in methods)
    kind = pa.struct([(method, pa.list_(pa.float64())) for method in methods])

    def run(x: np.ndarray, given: pa.ListScalar) -> dict:
        held = processor(x)
        return {method: _with_nulls(getattr(held, method)(), given) for method in methods}

    @F.arrow_udf(result)
    def apply(lists: pa.Array) -> pa.Array:
        pairs = zip(_items(lists), lists, strict=True)
        return pa.array([run(x, given) if x is not None and len(x) else None for x, given in pairs], kind)

    return apply(array)


def map_trials(
    trials: DataFrame,
    train: Callable[[Mapping], Mapping[str, float]],
    metrics: Sequence[str],
    config: str = "config",
    partitions: int | None = None,
) -> DataFrame:
    """Run ``train(config)`` for every trial and add its metrics.

    ``partitions`` spreads a short trial table whose trials are long.
    """
    kind = pa.struct([(name, pa.float64()) for name in metrics])

    @F.arrow_udf(", ".join(f"{name} double" for name in metrics))
    def apply(configs: pa.Array) -> pa.Array:
        return pa.array([dict(train(one)) for one in configs.to_pylist()], kind)

    spread = trials.repartition(partitions) if partitions else trials
    return spread.withColumn("__metrics", apply(config)).select(*trials.columns, "__metrics.*")


def map_trial_batches(
    trials: DataFrame,
    train: Callable[[Mapping[str, np.ndarray]], Mapping[str, np.ndarray]],
    metrics: Sequence[str],
    config: str = "config",
    partitions: int | None = None,
) -> DataFrame:
    """Like :func:`map_trials`, for a ``train`` that takes many trials at a time: it gets the
    fields of their configs as arrays and returns an array per metric."""
    kind = pa.struct([(name, pa.float64()) for name in metrics])

    @F.arrow_udf(", ".join(f"{name} double" for name in metrics))
    def apply(configs: pa.Array) -> pa.Array:
        if not len(configs):
            return pa.array([], kind)
        names = [configs.type.field(i).name for i in range(configs.type.num_fields)]
        found = train({name: configs.field(name).to_numpy(zero_copy_only=False) for name in names})
        columns = [pa.array(np.asarray(found[name], np.float64)) for name in metrics]
        return pa.StructArray.from_arrays(columns, list(metrics))

    spread = trials.repartition(partitions) if partitions else trials
    return spread.withColumn("__metrics", apply(config)).select(*trials.columns, "__metrics.*")


def mean_by_batches(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    """Group means from Python: each batch gives sums and counts, Spark adds them up.

    A grouped Python aggregate would collect a whole group in one worker; sums
    per batch keep any group size in bounds and shrink before the shuffle.
    """
    fields = [df.schema[key] for key in keys]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sums = table.group_by(list(keys)).aggregate([("__value", "sum"), ("__value", "count")])
            sums = sums.select([*keys, "__value_sum", "__value_count"])
            yield from sums.rename_columns([*keys, "sum", "count"]).to_batches()

    parts = df.select(*keys, F.col(value).cast("double").alias("__value")).mapInArrow(
        partial, f"{schema}, `sum` double, `count` bigint"
    )
    return parts.groupBy(*keys).agg(F.try_divide(F.sum("sum"), F.sum("count")).alias(out))

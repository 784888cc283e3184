"""Exact order statistics by narrowing histograms, without sorting the data.

``orderBy(...).limit(n)`` funnels every partition's first ``n`` rows into one
task; with ``n`` a fifth of the table that is the table. Counting rows per key
range finds the cut-off in a few column-pruned passes whose results have at
most ``FANOUT`` rows, and what remains is a plain filter on a literal.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 65536


def kth_smallest(
    df: DataFrame, key: Column, k: int, bounds: tuple[int, int] | None = None
) -> tuple[int, int] | None:
    """``(cut, spare)``: the rows with key <= cut number ``k + spare``.

    ``spare`` is above 0 only when rows tie on the k-th key itself. Null keys
    are left out; ``None`` if fewer than ``k`` rows remain. ``bounds`` spares the
    pass that finds the smallest and the largest key.
    """
    keys = df.select(key.cast("bigint").alias("v")).where("v IS NOT NULL")
    if bounds is None:
        bounds = keys.agg(F.min("v"), F.max("v")).first()
    low, high = bounds
    if k < 1 or low is None:
        return None
    wanted = k
    while True:
        width = (high - low) // FANOUT + 1
        # differences of keys far apart do not fit a long
        wide = high - low >= 1 << 63
        distance = f"(CAST(v AS DECIMAL(20,0)) - {low}BD)" if wide else f"(v - ({low}L))"
        counts = (
            keys.where(F.col("v").between(F.lit(low), F.lit(high)))
            .groupBy(F.expr(f"CAST({distance} DIV {width}{'BD' if wide else 'L'} AS BIGINT)").alias("slot"))
            .count()
            .toArrow()
            .sort_by("slot")
        )
        reached = np.cumsum(counts["count"].to_numpy())
        place = int(np.searchsorted(reached, wanted))
        if place == len(reached):
            return None
        slot, rows = counts["slot"][place].as_py(), counts["count"][place].as_py()
        wanted -= int(reached[place]) - rows
        low, high = low + slot * width, min(high, low + slot * width + width - 1)
        if rows == wanted or low == high:
            return high, rows - wanted


def first_k(
    df: DataFrame,
    key: Column,
    k: int,
    tiebreak: Column | None = None,
    bounds: tuple[int, int] | None = None,
) -> Column:
    """Predicate that holds for exactly the ``k`` rows with the smallest key.

    Ties on the cut-off key are split by ``tiebreak``, an integer that tells the
    tied rows apart. With fewer than ``k`` keyed rows it holds for all of them.
    """
    if k <= 0:
        return F.lit(False)
    found = kth_smallest(df, key, k, bounds)
    if found is None:
        return key.isNotNull()
    cut, spare = found
    if spare == 0:
        return key <= F.lit(cut)
    if tiebreak is None:
        raise ValueError("rows tie at the cut-off: pass a tiebreak column")
    tied = df.where(key == F.lit(cut))
    inner = first_k(tied, tiebreak, tied.count() - spare)
    return (key < F.lit(cut)) | ((key == F.lit(cut)) & inner)

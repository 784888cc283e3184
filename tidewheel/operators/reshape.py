"""Between wide and long, lists and rows, rows and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_column(df: DataFrame, name: str, ids: Sequence[str] = ()) -> DataFrame:
    return df.select(*ids, name)


def wide_to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Every column in ``columns`` becomes a series named after it."""
    return df.unpivot(list(ids), list(columns), "series", "y")


def long_to_wide(
    df: DataFrame, index: Sequence[str], series: str, names: Sequence[str], value: Column
) -> DataFrame:
    """One column per name in ``names``; ``value`` aggregates what shares a cell.

    Naming the columns up front keeps the schema fixed and saves the pass that
    would look for them.
    """
    return df.groupBy(*index).pivot(series, list(names)).agg(value)


def explode_list(df: DataFrame, ids: Sequence[str], array: str, out: str = "x") -> DataFrame:
    """A list column as rows ``(ids, pos, x)``, positions from 0."""
    return df.select(*ids, F.posexplode(array).alias("pos", out))


def collect_list_ordered(
    df: DataFrame, ids: Sequence[str], value: str = "x", position: str = "pos", out: str = "xs"
) -> DataFrame:
    """Rows back to one list per id, in position order.

    For lists that were rows of a table before, and so are known to fit a row.
    """
    pairs = F.array_sort(F.collect_list(F.struct(position, value)))
    return df.groupBy(*ids).agg(F.transform(pairs, lambda p: p[value]).alias(out))


def cast_float(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Narrow ``columns`` to single precision."""
    return df.withColumns({name: F.col(name).cast("float") for name in columns})


def results_map(columns: Sequence[str]) -> Column:
    """The named result columns of a row as one map, sorted by name."""
    entries = [
        F.struct(F.lit(name).alias("key"), F.col(name).alias("value")) for name in sorted(columns)
    ]
    return F.map_from_entries(F.array(*entries))

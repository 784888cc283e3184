"""Small helpers for comparing DataFrames in tests."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assert_same_rows(left: DataFrame, right: DataFrame) -> None:
    """Same rows the same number of times; for small fixtures."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    bags = [Counter(map(str, df.select(columns).collect())) for df in (left, right)]
    assert bags[0] == bags[1]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(
        *(
            (F.round(name, places) if kind == "double" else F.col(name)).alias(name)
            for name, kind in df.dtypes
        )
    )


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()

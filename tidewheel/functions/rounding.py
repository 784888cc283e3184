"""Rounding that stays in floating point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_places(value: Column | str, places: int) -> Column:
    """A double rounded to decimal places, halves away from zero.

    ``round`` takes every double through a decimal, which costs more than most of
    what is rounded here; it is left for values too large for the direct way.
    """
    x = F.col(value) if isinstance(value, str) else value
    scale = F.lit(10.0**places)
    direct = F.signum(x) * F.floor(F.abs(x) * scale + F.lit(0.5)) / scale
    return F.when(F.abs(x) < F.lit(1e15 / 10.0**places), direct).otherwise(F.round(x, places))

"""Functions over one array column; each row's list is handled where it lies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    An expression used inside a lambda is evaluated per element; binding it
    through a one-element array keeps list statistics at one pass.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x)


def present(xs: Column) -> Column:
    """The list without its nulls."""
    return F.filter(xs, lambda x: x.isNotNull())


def mean_list(xs: Column) -> Column:
    """Mean of a list, nulls left out; null for an empty list."""
    return bind(present(xs), lambda v: F.try_divide(total(v), F.size(v)))


def minmax_list(xs: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """List scaled to ``low..high``; a constant list becomes ``low``; nulls stay null."""
    stats = F.struct(F.array_min(xs).alias("low"), F.array_max(xs).alias("high"))
    return bind(
        stats,
        lambda s: F.transform(xs, lambda x: minmax_value(x, s["low"], s["high"], low, high)),
    )


def standard_list(xs: Column) -> Column:
    """List as z-scores by population deviation; a constant list becomes 0."""

    def with_mean(mean: Column) -> Column:
        spread = F.sqrt(mean_list(F.transform(xs, lambda x: (x - mean) * (x - mean))))
        return bind(spread, lambda sd: F.transform(xs, lambda x: standard_value(x, mean, sd)))

    return bind(mean_list(xs), with_mean)


def minmax_value(
    x: Column, smallest: Column, largest: Column, low: float = 0.0, high: float = 1.0
) -> Column:
    scaled = (x - smallest) / (largest - smallest) * F.lit(high - low) + F.lit(low)
    return F.when(largest > smallest, scaled).when(x.isNotNull(), F.lit(float(low)))


def standard_value(x: Column, mean: Column, deviation: Column) -> Column:
    return F.when(deviation > 0, (x - mean) / deviation).when(x.isNotNull(), F.lit(0.0))


def dot(xs: Column, weights: Column) -> Column:
    return total(F.zip_with(xs, weights, lambda x, w: x * w))


def relu(x: Column) -> Column:
    return F.greatest(x, F.lit(0.0))


def logspace(start: Column | float, stop: Column | float, num: int) -> Column:
    """``num`` values evenly spaced in the exponent, from 10^start to 10^stop."""
    first = F.lit(start) if not isinstance(start, Column) else start
    last = F.lit(stop) if not isinstance(stop, Column) else stop
    step = (last - first) / F.lit(float(max(num - 1, 1)))
    return F.transform(
        F.sequence(F.lit(0), F.lit(num - 1)), lambda i: F.pow(F.lit(10.0), first + i * step)
    )


def cap_words(text: Column, limit: int) -> Column:
    """The first ``limit`` blank-separated words (words, not model tokens)."""
    return F.array_join(F.slice(F.split(text, " "), 1, limit), " ")

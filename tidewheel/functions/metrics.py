"""Quality measures as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mse(actual: Column, predicted: Column) -> Column:
    error = actual - predicted
    return F.avg(error * error)


def negated(score: Column) -> Column:
    """Turn a "higher is better" score into a loss, or back."""
    return -score


def accuracy(label: Column, predicted: Column) -> Column:
    return F.avg((label == predicted).cast("double"))


def log_loss(probabilities: Column, label: Column, floor: float = 1e-15) -> Column:
    """Multi-class log loss; ``label`` is the 0-based index into ``probabilities``."""
    chosen = F.element_at(probabilities, label.cast("int") + 1)
    return -F.avg(F.ln(F.greatest(chosen, F.lit(floor))))


def mean_score(value: Column) -> Column:
    """Sum over count; null where there is nothing to average."""
    return F.try_divide(F.sum(value), F.count(value))

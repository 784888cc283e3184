"""One-step forecasts of many series.

Facts are first added up per series and period, so a series is as long as its
calendar however many rows it has, and only then laid out as one ordered list
per series. ARIMA(1,1,1) is fitted by conditional sum of squares over a fixed
grid of (phi, theta); other orders by Gauss-Newton from a Hannan-Rissanen start.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.arrays import bind

GRID_SIDE = 39
MIN_POINTS = 3
MOST_STEPS = 50


def totals_by_period(
    df: DataFrame,
    series: Sequence[str],
    period: Column,
    value: Column,
    out: str = "y",
    exact: str | None = None,
    every: str | None = None,
) -> DataFrame:
    """Sum of ``value`` per series and period.

    ``exact`` names a decimal type to add up in, for values known to fit it: such
    sums do not depend on the order of the rows. ``every``, an interval such as ``1 day``,
    fills the calendar of each series from its first period to its last: a period
    without rows has the sum 0.
    """
    summed = F.sum(value.cast(exact) if exact else value.cast("double"))
    totals = df.groupBy(*series, period.alias("period")).agg(summed.cast("double").alias(out))
    if every is None:
        return totals
    ends = df.groupBy(*series).agg(F.min(period).alias("__first"), F.max(period).alias("__last"))
    step = F.expr(f"INTERVAL {every}")
    days = ends.select(*series, F.explode(F.sequence("__first", "__last", step)).alias("period"))
    blank = days.select(*series, "period", F.lit(0.0).alias(out))
    return totals.unionByName(blank).groupBy(*series, "period").agg(F.sum(out).alias(out))


def series_lists(
    df: DataFrame, series: Sequence[str], period: str = "period", value: str = "y"
) -> DataFrame:
    """One row per series with its values in period order; one input row per period."""
    pairs = F.array_sort(F.collect_list(F.struct(period, value)))
    return df.groupBy(*series).agg(F.transform(pairs, lambda p: p[value]).alias("ys"))


def css_forecast(ys: Column) -> Column:
    """ARIMA(1,1,1) forecast of the next value as a struct, on the JVM.

    With w the first differences and residuals e_t = w_t - phi w_(t-1) -
    theta e_(t-1) started from zeros, the pair with the smallest residual sum of
    squares wins (ties: rounded sum, phi, theta). Interpreted lambdas make this
    right for tens of series; :func:`css_forecast_fast` is for many.
    """
    n = F.size(ys)
    steps = F.zip_with(
        F.slice(ys, 2, F.greatest(n - 1, F.lit(0))),
        F.slice(ys, 1, F.greatest(n - 1, F.lit(0))),
        lambda after, before: after - before,
    )
    start = F.struct(F.lit(0.0).alias("e"), F.lit(0.0).alias("sse"), F.lit(0.0).alias("w"))

    def candidate(ws: Column, i: Column) -> Column:
        phi = (F.floor(i / GRID_SIDE) - 19) / F.lit(20.0)
        theta = (i % GRID_SIDE - 19) / F.lit(20.0)

        def advance(acc: Column, w: Column) -> Column:
            residual = w - phi * acc["w"] - theta * acc["e"]
            return bind(
                residual,
                lambda e: F.struct(
                    e.alias("e"), (acc["sse"] + e * e).alias("sse"), w.alias("w")
                ),
            )

        return bind(
            F.aggregate(ws, start, advance),
            lambda end: F.struct(
                F.round(end["sse"], 4).alias("sse"),
                phi.alias("phi"),
                theta.alias("theta"),
                (phi * end["w"] + theta * end["e"]).alias("step"),
            ),
        )

    grid = F.sequence(F.lit(0), F.lit(GRID_SIDE * GRID_SIDE - 1))
    best = bind(steps, lambda ws: F.array_min(F.transform(grid, lambda i: candidate(ws, i))))
    fitted = bind(
        best,
        lambda b: F.struct(
            (F.element_at(ys, -1) + b["step"]).alias("forecast"),
            b["phi"].alias("phi"),
            b["theta"].alias("theta"),
        ),
    )
    return F.when(n >= MIN_POINTS, fitted)


_PHI, _THETA = (
    axis.ravel() for axis in np.meshgrid(*[(np.arange(GRID_SIDE) - 19) / 20.0] * 2, indexing="ij")
)


def _css_fit(y: np.ndarray) -> dict | None:
    """The grid of :func:`css_forecast`, all candidates advanced together."""
    if len(y) < MIN_POINTS:
        return None
    e = np.zeros(len(_PHI))
    sse = np.zeros(len(_PHI))
    before = 0.0
    for w in np.diff(y):
        e = w - _PHI * before - _THETA * e
        sse += e * e
        before = w
    best = int(np.argmin(np.round(sse, 4)))
    step = _PHI[best] * before + _THETA[best] * e[best]
    return {"forecast": y[-1] + step, "phi": _PHI[best], "theta": _THETA[best]}


BLOCK = 64
"""Series that are fitted together; their candidates take about a megabyte a step."""


def _css_fits(lists: Sequence[np.ndarray]) -> list[dict | None]:
    """:func:`_css_fit` of many series: all candidates of a block of them, step by step.

    Longer series come first in a block, so those that go on are always its front.
    """
    found: list[dict | None] = [None] * len(lists)
    order = sorted((i for i, y in enumerate(lists) if len(y) >= MIN_POINTS), key=lambda i: -len(lists[i]))
    for begin in range(0, len(order), BLOCK):
        rows = order[begin : begin + BLOCK]
        lengths = np.array([len(lists[i]) - 1 for i in rows])
        steps = np.zeros((lengths[0], len(rows)))
        for column, i in enumerate(rows):
            steps[: lengths[column], column] = np.diff(lists[i])
        e, sse = np.zeros((len(rows), len(_PHI))), np.zeros((len(rows), len(_PHI)))
        before = np.zeros(len(rows))
        for at, w in enumerate(steps):
            live = int(np.searchsorted(-lengths, -at))  # series longer than this step
            e[:live] = w[:live, None] - before[:live, None] * _PHI - _THETA * e[:live]
            sse[:live] += e[:live] * e[:live]
            before[:live] = w[:live]
        best = np.argmin(np.round(sse, 4), axis=1)
        ahead = _PHI[best] * before + _THETA[best] * e[np.arange(len(rows)), best]
        for i, b, step in zip(rows, best, ahead, strict=True):
            found[i] = {"forecast": lists[i][-1] + step, "phi": _PHI[b], "theta": _THETA[b]}
    return found


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    for item in column:
        values = item.values
        yield (
            np.empty(0)
            if values is None
            else values.to_numpy(zero_copy_only=False).astype("float64")
        )


def css_forecast_fast(ys: str | Column) -> Column:
    """:func:`css_forecast` in Arrow batches, for thousands of series and more."""

    @F.arrow_udf("forecast double, phi double, theta double")
    def fit(lists: pa.Array) -> pa.Array:
        kind = pa.struct([(name, pa.float64()) for name in ("forecast", "phi", "theta")])
        return pa.array(_css_fits(list(_lists(lists))), kind)

    return fit(ys)


def forecast_series(lists: DataFrame, partitions: int | None = None) -> DataFrame:
    """Forecast every row of :func:`series_lists`; ``partitions`` spreads few, long series."""
    spread = lists.repartition(partitions) if partitions else lists
    return spread.withColumn("fit", css_forecast_fast("ys")).select(
        *(name for name in lists.columns if name != "ys"), "fit.*"
    )


def _residuals(w: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Residuals and their derivatives by (phi, theta), from zero pre-sample values."""
    p, q = len(phi), len(theta)
    e = np.zeros(len(w) + q)
    slopes = np.zeros((len(w) + q, p + q))
    padded = np.concatenate([np.zeros(p), w])
    for t in range(len(w)):
        past_w = padded[t : t + p][::-1]
        past_e = e[t : t + q][::-1]
        e[t + q] = w[t] - phi @ past_w - theta @ past_e
        slopes[t + q] = -np.concatenate([past_w, past_e]) - theta @ slopes[t : t + q][::-1]
    return e[q:], slopes[q:]


def _start(w: np.ndarray, p: int, q: int) -> np.ndarray:
    """Hannan-Rissanen: residuals of a long autoregression stand in for the shocks."""
    if q == 0:
        shocks = np.zeros(len(w))
    else:
        lags = min(max(p, q) + 2, len(w) // 3)
        past = np.column_stack([w[lags - i - 1 : len(w) - i - 1] for i in range(lags)])
        fit = np.linalg.lstsq(past, w[lags:], rcond=None)[0]
        shocks = np.concatenate([np.zeros(lags), w[lags:] - past @ fit])
    first = max(p, q)
    columns = [w[first - i - 1 : len(w) - i - 1] for i in range(p)]
    columns += [shocks[first - j - 1 : len(w) - j - 1] for j in range(q)]
    found = np.linalg.lstsq(np.column_stack(columns), w[first:], rcond=None)[0]
    return np.clip(found, -0.95, 0.95)


def _order_fit(y: np.ndarray, p: int, d: int, q: int) -> dict:
    if len(y) < d + 3 * max(p, q) + p + q + 2:
        return {"forecast": None, "status": "too short"}
    w = np.diff(y, d)
    params = np.zeros(0)
    settled = p + q == 0
    if p + q:
        params = _start(w, p, q)
        e, slopes = _residuals(w, params[:p], params[p:])
        for _ in range(MOST_STEPS):
            move = np.linalg.lstsq(slopes, -e, rcond=None)[0]
            for shrink in 0.5 ** np.arange(12):
                trial = params + shrink * move
                tried, tried_slopes = _residuals(w, trial[:p], trial[p:])
                if np.isfinite(tried).all() and tried @ tried < e @ e:
                    break
            else:
                settled = True  # no step in this direction is better
                break
            settled = e @ e - tried @ tried < 1e-10 * (e @ e)
            params, e, slopes = trial, tried, tried_slopes
            if settled:
                break
    else:
        e = w
    ahead = params[:p] @ w[::-1][:p] + params[p:] @ e[::-1][:q]
    level = sum((-1) ** (j + 1) * comb(d, j) * y[-j] for j in range(1, d + 1))
    forecast = float(ahead + level)
    if not np.isfinite(forecast):
        return {"forecast": None, "status": "diverged"}
    return {"forecast": forecast, "status": "ok" if settled else "not converged"}


def forecast_order(
    lists: DataFrame, order: tuple[int, int, int], partitions: int | None = None
) -> DataFrame:
    """Forecast with any order (p, d, q): ``(series..., forecast, status)``."""
    p, d, q = order

    @F.arrow_udf("forecast double, status string")
    def fit(ys: pa.Array) -> pa.Array:
        return pa.array(
            [_order_fit(y, p, d, q) for y in _lists(ys)],
            pa.struct([("forecast", pa.float64()), ("status", pa.string())]),
        )

    spread = lists.repartition(partitions) if partitions else lists
    return spread.withColumn("fit", fit("ys")).select(
        *(name for name in lists.columns if name != "ys"), "fit.*"
    )

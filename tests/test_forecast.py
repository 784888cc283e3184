import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.operators import forecast
from tidewheel.plans import forecasting


def test_goldens_at_the_check_size(spark):
    fitted = forecast.forecast_series(forecasting.daily_series(spark, "/root/testdata/sf0.01"))
    found = {r.series: round(r.forecast, 4) for r in fitted.collect()}
    assert found == {
        "click": 3468.2702,
        "error": 3471.7551,
        "purchase": 3311.8566,
        "signup": 3273.765,
        "view": 3232.8678,
    }


def test_both_forms_agree(spark):
    rng = np.random.default_rng(0)
    lists = [(i, np.cumsum(rng.normal(size=n)).tolist()) for i, n in enumerate([0, 1, 2, 3, 4, 20, 40])]
    df = spark.createDataFrame(lists, "id int, ys array<double>")
    both = df.select(
        F.size("ys").alias("n"),
        forecast.css_forecast(F.col("ys")).alias("slow"),
        forecast.css_forecast_fast("ys").alias("fast"),
    )
    for n, slow, fast in both.collect():
        if n < forecast.MIN_POINTS:
            assert slow is None and (fast is None or fast.forecast is None)
        else:
            assert tuple(slow) == pytest.approx(tuple(fast), abs=1e-9)


def test_series_are_as_long_as_the_calendar(spark):
    facts = spark.range(1000).select(
        F.lit("a").alias("series"), (F.col("id") % 12).alias("m"), F.lit(1.0).alias("v")
    )
    totals = forecast.totals_by_period(facts, ["series"], F.col("m"), F.col("v"))
    row = forecast.series_lists(totals, ["series"]).first()
    assert len(row.ys) == 12 and sum(row.ys) == 1000


def _arma(phi, theta, n, seed):
    shocks = np.random.default_rng(seed).normal(size=n)
    w = np.zeros(n)
    for t in range(1, n):
        w[t] = phi * w[t - 1] + shocks[t] + theta * shocks[t - 1]
    return w


def test_order_fit_recovers_the_process():
    w = _arma(0.6, 0.3, 3000, 1)
    start = forecast._start(w, 1, 1)
    assert start == pytest.approx([0.6, 0.3], abs=0.1)
    e, slopes = forecast._residuals(w, np.array([0.5]), np.array([0.2]))
    h = 1e-6
    for i, moved in enumerate(([0.5 + h, 0.2], [0.5, 0.2 + h])):
        e2, _ = forecast._residuals(w, np.array(moved[:1]), np.array(moved[1:]))
        assert (e2 - e)[-50:] / h == pytest.approx(slopes[-50:, i], abs=1e-3)


@pytest.mark.parametrize("order", [(0, 0, 0), (1, 0, 0), (0, 1, 1), (1, 1, 1), (2, 1, 2), (0, 2, 0)])
def test_orders(spark, order):
    ys = np.cumsum(_arma(0.5, 0.2, 80, 3)).tolist()
    df = spark.createDataFrame([("long", ys), ("short", ys[:1])], "series string, ys array<double>")
    rows = {r.series: r for r in forecast.forecast_order(df, order).collect()}
    assert rows["long"].status == "ok" and np.isfinite(rows["long"].forecast)
    assert rows["short"].status == "too short" and rows["short"].forecast is None


def test_differences_alone_extend_a_line(spark):
    df = spark.createDataFrame([("s", [float(3 * i) for i in range(10)])], "series string, ys array<double>")
    assert forecast.forecast_order(df, (0, 2, 0)).first().forecast == 30
    assert forecast.forecast_order(df, (0, 1, 0)).first().forecast == 27


def test_small_and_large_values_are_summed_as_they_are(spark):
    facts = spark.createDataFrame([("a", 1, 0.004)] * 3 + [("b", 1, 1e17)], "series string, m int, v double")
    totals = forecast.totals_by_period(facts, ["series"], F.col("m"), F.col("v"))
    assert {r.series: r.y for r in totals.collect()} == {"a": pytest.approx(0.012), "b": 1e17}


def test_unsettled_fits_say_so(monkeypatch):
    y = np.cumsum(np.random.default_rng(1).normal(size=80))
    assert forecast._order_fit(y, 2, 1, 2)["status"] == "ok"
    monkeypatch.setattr(forecast, "MOST_STEPS", 0)
    monkeypatch.setattr(forecast, "_start", lambda w, p, q: np.full(p + q, 0.5))
    assert forecast._order_fit(y, 2, 1, 2)["status"] == "not converged"


def test_gaps_in_a_calendar_are_zero(spark):
    rows = [("a", "2024-01-01", 1.5), ("a", "2024-01-04", 2.0), ("a", "2024-01-04", 1.0), ("b", "2024-03-01", 7.0)]
    facts = spark.createDataFrame(rows, "s string, d string, v double").withColumn("d", F.to_date("d"))
    totals = forecast.totals_by_period(facts, ["s"], F.col("d"), F.col("v"), every="1 day")
    lists = {r.s: r.ys for r in forecast.series_lists(totals, ["s"]).collect()}
    assert lists == {"a": [1.5, 0.0, 0.0, 3.0], "b": [7.0]}
    months = forecast.totals_by_period(facts, [], F.trunc("d", "month"), F.col("v"), every="1 month")
    assert [r.y for r in months.orderBy("period").collect()] == [4.5, 0.0, 7.0]


def test_series_fitted_together_and_alone():
    rng = np.random.default_rng(7)
    lists = [rng.normal(size=n).cumsum() for n in rng.integers(0, 40, 200)]
    for one, many in zip(map(forecast._css_fit, lists), forecast._css_fits(lists), strict=True):
        assert (one is None) == (many is None)
        if one:
            assert (one["phi"], one["theta"]) == (many["phi"], many["theta"])
            assert one["forecast"] == pytest.approx(many["forecast"], rel=1e-12)

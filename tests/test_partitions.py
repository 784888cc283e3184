"""One partition and many must give the same rows."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import assert_same_rows, plan_of, rounded
from tidewheel.operators import fanout, forecast, ordering, scale, trials
from tidewheel.sources.tables import parquet_table

OPERATORS = {
    "minmax": lambda df: scale.minmax_group(df, ["user_id"], "value"),
    "zscore": lambda df: scale.zscore_group(df, ["user_id"], "value"),
    "mean": lambda df: scale.mean_score(df, ["user_id"], "value"),
    "mean by batches": lambda df: fanout.mean_by_batches(df, ["user_id"], "value"),
    "running sum": lambda df: ordering.running_sum(df, ["user_id"], ["event_id"], "value"),
    "ordinal": lambda df: ordering.ordinal(df, [], ["event_id"]),
    "difference": lambda df: ordering.difference(df, ["user_id"], ["event_id"], "value"),
    "split": lambda df: trials.holdout_split(df, "event_id"),
    "exact split": lambda df: trials.holdout_exact(df, "event_id"),
    "folds": lambda df: trials.kfold_stratified(df, "event_type", "event_id"),
    "forecast": lambda df: forecast.forecast_series(
        forecast.series_lists(
            forecast.totals_by_period(df, ["event_type"], F.to_date("ts"), F.col("value")), ["event_type"]
        )
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_same_rows(spark, folder, name):
    events = parquet_table(spark, folder, "events")
    one, many = events.coalesce(1), events.repartition(7)
    assert_same_rows(rounded(OPERATORS[name](one), 5), rounded(OPERATORS[name](many), 5))


@pytest.mark.parametrize("name", ["minmax", "zscore", "running sum", "difference", "folds"])
def test_native_plans(spark, folder, name):
    plan = plan_of(OPERATORS[name](parquet_table(spark, folder, "events")))
    assert not any(name in plan for name in ("Python", "CartesianProduct", "NestedLoopJoin"))

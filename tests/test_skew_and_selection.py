import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import assert_same_rows, plan_of
from tidewheel.operators import selection, skew
from tidewheel.sources import tables


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 97)
    return spark.range(2000).select("id", key.cast("bigint").alias("k"), (F.col("id") % 50).alias("x"))


@pytest.mark.parametrize("hot_rows", [10, 100, 10_000])
def test_stats_reach_every_row(rows, hot_rows):
    stats = [F.min("x").alias("low"), F.count(F.lit(1)).alias("n")]
    joined = skew.attach_stats(rows, ["k"], stats, hot_share=0.01, hot_rows=hot_rows)
    by_key = {r.k: (r.low, r.n) for r in rows.groupBy("k").agg(*stats).collect()}
    result = joined.collect()
    assert len(result) == 2000
    assert all((r.low, r.n) == by_key[r.k] for r in result)


def test_hot_rows_are_not_shuffled(rows):
    plan = plan_of(skew.attach_stats(rows, ["k"], [F.min("x").alias("low")]))
    first = plan.split("Union")[1].split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in first


def test_several_keys(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("a", None, 6.0)], "s string, i int, x double")
    joined = skew.attach_stats(df, ["s", "i"], [F.avg("x").alias("m")], 0.1, 1)
    assert sorted((r.x, r.m) for r in joined.collect()) == [(2.0, 3.0), (4.0, 3.0), (6.0, 6.0)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-(2**40), 2**40), min_size=1, max_size=60), st.data())
def test_kth_smallest(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    cut, spare = selection.kth_smallest(df, F.col("v"), k)
    below = [v for v in values if v <= cut]
    assert len(below) == k + spare
    assert max(below) == sorted(values)[k - 1]
    assert spare == 0 or below.count(max(below)) > spare


def test_first_k_splits_ties(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 3)
    chosen = df.where(selection.first_k(df, F.col("v"), 40, tiebreak=F.col("id")))
    ranked = sorted((i % 3, i) for i in range(100))[:40]
    assert sorted((r.v, r.id) for r in chosen.collect()) == ranked
    with pytest.raises(ValueError):
        selection.first_k(df, F.col("v"), 40)


def test_first_k_edges(spark):
    df = spark.range(5)
    for k, expected in [(0, 0), (5, 5), (9, 5)]:
        assert df.where(selection.first_k(df, F.col("id"), k)).count() == expected
    none = df.where("false")
    assert none.where(selection.first_k(none, F.col("id"), 3)).count() == 0


def test_limit_reaches_the_scan(spark, folder):
    orders = tables.parquet_table(spark, folder, "orders")
    limited = tables.limited(orders, "o_orderkey", 100)
    assert "LessThanOrEqual(o_orderkey" in plan_of(limited)
    assert "Exchange" not in plan_of(limited)
    assert_same_rows(limited, orders.orderBy("o_orderkey").limit(100))


def test_smallest_of_keys_that_span_all_longs(spark):
    values = [-(2**63), -(9 * 10**18), -1, 0, 5, 9 * 10**18, 2**63 - 1]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k, value in enumerate(values, 1):
        assert selection.kth_smallest(df, F.col("v"), k)[0] >= value
        kept = df.where(selection.first_k(df, F.col("v"), k)).collect()
        assert sorted(row.v for row in kept) == values[:k]

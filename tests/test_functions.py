import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewheel.functions import arrays, keyed, metrics
from tidewheel.functions.rounding import to_places

LISTS = st.lists(
    st.lists(st.one_of(st.none(), st.integers(-1000, 1000).map(float)), max_size=8),
    min_size=1,
    max_size=20,
)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def doubles(values):
    return F.array(*map(F.lit, values)).cast("array<double>")


def test_keyed_uniform_goldens(spark):
    us = [r.u for r in spark.range(3).select(keyed.keyed_uniform(42, "id").alias("u")).collect()]
    assert us == [0.66052864654921, 0.34786711167544127, 0.46810244559310377]
    assert us == [keyed.uniform_of(42, i) for i in range(3)]


def test_keyed_draws_do_not_follow_partitions(spark):
    draw = keyed.keyed_normal("n", "id")
    few = spark.range(0, 500, 1, 1).select("id", draw.alias("x"))
    many = spark.range(0, 500, 1, 1).repartition(7).select("id", draw.alias("x"))
    assert sorted(few.collect()) == sorted(many.collect())


def test_keyed_normal_moments(spark):
    row = spark.range(20000).select(keyed.keyed_normal("m", "id").alias("x"))
    row = row.agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd")).first()
    assert abs(row["mean"]) < 0.03 and abs(row["sd"] - 1) < 0.03


def test_keyed_int_covers_closed_range(spark):
    drawn = spark.range(5000).select(keyed.keyed_int(1, 6, "die", "id").alias("x"))
    assert sorted(r.x for r in drawn.distinct().collect()) == [1, 2, 3, 4, 5, 6]


def test_scaling_goldens(spark):
    assert one(spark, arrays.minmax_list(doubles([100, 200, 300]))) == [0, 0.5, 1]
    assert one(spark, arrays.minmax_list(doubles([400, 500, 600]), -1, 1)) == [-1, 0, 1]
    standard = one(spark, arrays.standard_list(doubles([100, 200, 300])))
    assert standard == pytest.approx([-1.224745, 0, 1.224745], abs=1e-6)
    assert one(spark, arrays.minmax_list(doubles([5, 5]), 2, 3)) == [2, 2]
    assert one(spark, arrays.standard_list(doubles([5, 5]))) == [0, 0]


def test_mean_goldens(spark):
    means = [one(spark, arrays.mean_list(doubles(v))) for v in ([50, 60, 70], [80, 90, 100], [65, 75, 85])]
    assert means == [60, 90, 75]
    assert one(spark, arrays.mean_list(F.lit([]).cast("array<double>"))) is None


@settings(max_examples=6, deadline=None)
@given(LISTS)
def test_scaled_lists_keep_their_promises(spark, lists):
    rows = spark.createDataFrame([(xs,) for xs in lists], "xs array<double>")
    scaled = rows.select(
        "xs",
        arrays.minmax_list(F.col("xs"), -1, 2).alias("unit"),
        arrays.standard_list(F.col("xs")).alias("z"),
        arrays.minmax_list(F.transform("xs", lambda x: x * 3 + 7), -1, 2).alias("moved"),
    )
    for xs, unit, z, moved in scaled.collect():
        assert [x is None for x in xs] == [x is None for x in unit] == [x is None for x in z]
        values = [x for x in xs if x is not None]
        if not values:
            continue
        present = [x for x in unit if x is not None]
        assert all(-1 - 1e-9 <= x <= 2 + 1e-9 for x in present)
        assert present == pytest.approx([x for x in moved if x is not None], abs=1e-9)
        zs = [x for x in z if x is not None]
        assert sum(zs) == pytest.approx(0, abs=1e-6)
        spread = math.sqrt(sum(x * x for x in zs) / len(zs))
        assert spread == pytest.approx(1 if len(set(values)) > 1 else 0, abs=1e-6)


def test_logspace_and_cap(spark):
    values = one(spark, arrays.logspace(-3, 0, 30))
    assert len(values) == 30
    assert values[0] == pytest.approx(1e-3) and values[-1] == pytest.approx(1)
    assert values[1] / values[0] == pytest.approx(values[29] / values[28])
    assert one(spark, arrays.cap_words(F.lit("a b c d"), 2)) == "a b"
    assert one(spark, arrays.cap_words(F.lit("a b"), 5)) == "a b"


def test_metrics(spark):
    rows = spark.createDataFrame(
        [(1.0, 2.0, 0, [0.5, 0.5]), (2.0, 2.0, 1, [0.25, 0.75])],
        "y double, p double, label int, probs array<double>",
    )
    row = rows.agg(
        metrics.mse(F.col("y"), F.col("p")).alias("mse"),
        metrics.negated(metrics.mse(F.col("y"), F.col("p"))).alias("score"),
        metrics.log_loss(F.col("probs"), F.col("label")).alias("loss"),
        metrics.accuracy(F.col("label"), F.lit(1)).alias("accuracy"),
        metrics.mean_score(F.col("y")).alias("mean"),
    ).first()
    assert row["mse"] == 0.5 and row["score"] == -0.5 and row["accuracy"] == 0.5 and row["mean"] == 1.5
    assert row["loss"] == pytest.approx(-(math.log(0.5) + math.log(0.75)) / 2)
    assert rows.where("false").agg(metrics.mean_score(F.col("y")).alias("m")).first()["m"] is None


def test_to_places(spark):
    for x, places, expected in [(1.23456, 2, 1.23), (-1.005, 1, -1.0), (0.0, 3, 0.0), (0.1 + 0.2, 6, 0.3), (2.5, 0, 3.0), (-2.5, 0, -3.0), (3e20, 4, 3e20)]:
        assert one(spark, to_places(F.lit(x), places)) == expected

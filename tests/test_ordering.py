"""The chunked path against plain windows, with one key holding most of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.helpers import assert_same_rows, plan_of, rounded
from tidewheel.operators import ordering
from tidewheel.operators.ordering import Layout

TINY = Layout(rows_per_chunk=125)
MANY = Layout(rows_per_chunk=7)


@pytest.fixture(scope="module")
def rows(spark):
    """2,000 rows, half of them of key 0 and some without a key; heavy values of ``a``."""
    ids = spark.range(2000)
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 97)
    a = F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 40 * 100)
    value = F.when(F.col("id") % 13 == 0, None).otherwise((F.col("id") * 7919) % 1000 / 8)
    df = ids.select("id", key.cast("bigint").alias("k"), a.alias("a"), value.alias("x"))
    name = F.concat(F.lit("é"), (F.col("id") * 17 % 50).cast("string"))
    at = F.timestamp_seconds(F.col("id") * 977 % 400)
    df = df.withColumns({"b": (F.col("id") * 31) % 2000, "name": name, "at": at})
    return df.withColumn("label", F.when(F.col("k").isNotNull(), F.concat(F.lit("g"), "k"))).repartition(5).persist()


@pytest.mark.parametrize(
    ("keys", "layout"), [(["k"], TINY), (["k"], Layout()), (["label", "a"], MANY), ([], TINY)]
)
@pytest.mark.parametrize("order", [["id"], ["a", "b"], ["name", "id"], ["at", "id"], ["name", "at", "id"]])
def test_matches_plain_windows(rows, keys, layout, order):
    window = Window.partitionBy(*keys).orderBy(*order)
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = rows.select(
        "id",
        F.sum("x").over(so_far).alias("s"),
        F.row_number().over(window).cast("bigint").alias("n"),
        (F.col("x") - F.lag("x").over(window)).alias("d"),
    )
    summed = ordering.running_sum(rows, keys, order, "x", "s", layout).select("id", "s")
    assert_same_rows(rounded(summed), rounded(expected.select("id", "s")))
    placed = ordering.ordinal(rows, keys, order, "n", layout).select("id", "n")
    assert_same_rows(placed, expected.select("id", "n"))
    moved = ordering.difference(rows, keys, order, "x", 1, "d", layout).select("id", "d")
    assert_same_rows(rounded(moved), rounded(expected.select("id", "d")))


def test_second_difference(rows):
    window = Window.partitionBy("k").orderBy("id")
    x, before, earlier = F.col("x"), F.lag("x").over(window), F.lag("x", 2).over(window)
    expected = rows.select("id", (x - before - before + earlier).alias("d"))
    moved = ordering.difference(rows, ["k"], ["id"], "x", 2, "d", TINY).select("id", "d")
    assert_same_rows(rounded(moved), rounded(expected))


def test_chunks_are_even_and_few_groups_are_cut(rows):
    chunks = ordering._chunked(rows, ["k"], ["id"], TINY)
    assert chunks.cut
    sizes = chunks.rows.groupBy("__chunk").count().toPandas()["count"]
    assert len(sizes) == 16 and sizes.max() <= TINY.rows_per_chunk + 1
    spans = chunks.rows.groupBy("k").agg(F.count_distinct("__chunk").alias("n"), F.first("__cut").alias("cut")).collect()
    assert all(row.cut for row in spans if row.n > 1)
    assert sum(row.cut for row in spans) <= 15 and any(row.n > 7 for row in spans)


def test_equal_order_columns_stay_together(rows):
    """Rows that nothing tells apart fall into one chunk."""
    chunks = ordering._chunked(rows, [], ["a"], TINY)
    assert chunks.rows.groupBy("a").agg(F.count_distinct("__chunk").alias("n")).where("n > 1").count() == 0


def test_sampled_splitters(spark):
    rows = spark.range(0, 300_000, 1, 6).selectExpr("id", "cast(id % 2 as string) as k")
    layout = Layout(rows_per_chunk=20_000)
    sizes = ordering._chunked(rows, ["k"], ["id"], layout).rows.groupBy("__chunk").count().toPandas()["count"]
    assert len(sizes) == 15 and sizes.max() < 2 * layout.rows_per_chunk
    placed = ordering.ordinal(rows, ["k"], ["id"], "n", layout)
    assert placed.where("n <> floor(id / 2) + 1").count() == 0


def test_one_shuffle_of_the_rows(spark):
    rows = spark.range(2000).selectExpr("id", "id % 2 AS k", "id * 1.5D AS x")
    plain = plan_of(ordering.ordinal(rows, ["k"], ["id"]))
    assert "Join" not in plain and plain.count("Exchange") == 1
    cut = plan_of(ordering.running_sum(rows, ["k"], ["id"], "x", layout=TINY))
    assert "SortMergeJoin" not in cut and "SinglePartition" not in cut.split("Subquery")[0]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "k int, id int, x double")
    assert ordering.ordinal(empty, [], ["id"]).count() == 0
    assert ordering.running_sum(empty, ["k"], ["id"], "x").count() == 0


def test_head_and_slice(spark):
    df = spark.createDataFrame([(2, [9.0]), (1, [1.0, 2.0, 3.0])], "id int, xs array<double>")
    assert [r.id for r in ordering.head_rows(df, ["id"], 1).collect()] == [1]
    assert ordering.slice_first(df, ["id"], "xs", 2).first()["xs"] == [1.0, 2.0]

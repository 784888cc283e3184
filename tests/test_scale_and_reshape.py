import pytest
from pyspark.sql import functions as F

from tests.helpers import assert_same_rows, plan_of
from tidewheel.operators import reshape, scale
from tidewheel.sources import generators, tables


@pytest.fixture(scope="module")
def groups(spark):
    rows = [("p", 100.0), ("p", 200.0), ("p", 300.0), ("c", 5.0), ("c", 5.0), ("n", None), ("m", 1.0), ("m", None)]
    return spark.createDataFrame(rows, "k string, x double")


def test_group_goldens(groups):
    scaled = scale.scale_groups(groups, ["k"], "x", {"z": "standard", "u": (-1.0, 1.0)})
    rows = {(r.k, r.x): (r.z, r.u) for r in scaled.collect()}
    assert rows[("p", 100.0)] == (pytest.approx(-1.224745, abs=1e-6), -1)
    assert rows[("p", 200.0)] == (0, 0)
    assert rows[("p", 300.0)] == (pytest.approx(1.224745, abs=1e-6), 1)
    assert rows[("c", 5.0)] == (0, -1)
    assert rows[("n", None)] == (None, None)
    assert rows[("m", 1.0)] == (0, -1) and rows[("m", None)] == (None, None)
    assert set(scaled.columns) == {"k", "x", "z", "u"}


def test_only_the_needed_statistics_are_computed(groups):
    assert "stddev" not in plan_of(scale.minmax_group(groups, ["k"], "x"))
    assert "min(" not in plan_of(scale.zscore_group(groups, ["k"], "x"))


def test_matrix_fitted_on_training_rows(spark):
    train = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    test = spark.createDataFrame([(5.0, 4.0)], "a double, b double")
    assert scale.standardize_matrix(test, ["a", "b"], fit_on=train).collect() == [(3.0, 0.0)]
    assert sorted(scale.standardize_matrix(train, ["a", "b"]).collect()) == [(-1.0, 0.0), (1.0, 0.0)]


def test_array_scalers(spark):
    lists = spark.createDataFrame([([1.0, 3.0],), ([],)], "xs array<double>")
    assert [r.scaled for r in scale.minmax_array(lists, "xs", (0, 10)).collect()] == [[0, 10], []]
    assert [r.scaled for r in scale.standard_array(lists, "xs").collect()] == [[-1, 1], []]


def test_wide_long_wide(spark):
    wide = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, None)], "t int, a double, b double")
    long = reshape.wide_to_long(wide, ["t"], ["a", "b"])
    assert long.count() == 4
    back = reshape.long_to_wide(long, ["t"], "series", ["a", "b"], F.first("y"))
    assert_same_rows(back, wide)


def test_lists_and_rows(spark):
    lists = spark.createDataFrame([(1, [3.0, 1.0, 2.0]), (2, [5.0])], "id int, xs array<double>")
    rows = reshape.explode_list(lists, ["id"], "xs").repartition(5)
    assert_same_rows(reshape.collect_list_ordered(rows, ["id"]), lists)


def test_results_map_is_sorted(spark):
    row = spark.createDataFrame([(1.0, 2.0)], "b double, a double")
    assert list(row.select(reshape.results_map(["b", "a"]).alias("m")).first()["m"].items()) == [
        ("a", 2.0),
        ("b", 1.0),
    ]


def test_cast_float(spark):
    df = reshape.cast_float(spark.createDataFrame([(0.1, "s")], "x double, s string"), ["x"])
    assert dict(df.dtypes) == {"x": "float", "s": "string"}


def test_generated_data(spark):
    ids = spark.range(20)
    lists = generators.generate_lists(ids, "id", 50)
    low, high, n = lists.agg(F.min("x"), F.max("x"), F.count("x")).first()
    assert n == 1000 and low >= 1 and high <= 100
    walks = generators.generate_walks(ids, "id", 100, F.lit(0.1))
    assert walks.groupBy("series").count().where("count <> 100").count() == 0
    table = generators.generate_regression(ids, "id", 12, noise=0.0)
    weights = spark.range(1).select(F.array(*generators.regression_weights(12, 10, 42))).first()[0]
    assert weights[10:] == [0, 0] and all(0 <= w <= 100 for w in weights)
    for row in table.collect():
        assert row["y"] == pytest.approx(sum(w * row[f"f{j}"] for j, w in enumerate(weights)))


def test_versions(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 3, "d")]
    df = spark.createDataFrame(rows, "k int, version int, v string")
    assert tables.as_of_version(df, ["k"], "version", 2).collect() == [(1, 2, "b")]
    assert sorted(tables.as_of_version(df, ["k"], "version", 3).collect()) == [(1, 3, "c"), (2, 3, "d")]


def test_tables_of_the_catalog(spark, tmp_path):
    df = spark.range(10)
    df.createOrReplaceTempView("ten")
    assert tables.table(spark, "ten").count() == 10
    assert tables.query(spark, "SELECT sum(id) AS s FROM {t}", t=df).first()["s"] == 45
    path = str(tmp_path / "out")
    tables.write_table(df.withColumn("p", F.col("id") % 2), path, partition_by=["p"], rows_per_file=3)
    assert spark.read.parquet(path).where("p = 1").count() == 5
    with pytest.raises(Exception, match="already exists"):
        tables.write_table(df, path)


def test_summary(spark):
    df = spark.createDataFrame([(1, None), (3, "b")], "a int, s string")
    assert tables.summary(df).collect() == [
        ("a", "int", 2, 0, "1", "3"),
        ("s", "string", 2, 1, "b", "b"),
    ]

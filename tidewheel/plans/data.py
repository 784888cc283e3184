"""Queries on reading, writing, generating and reshaping tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.arrays import logspace as logspace_values
from tidewheel.functions.arrays import mean_list, minmax_list, total
from tidewheel.functions.rounding import to_places
from tidewheel.operators import ordering, reshape
from tidewheel.operators.skew import spread
from tidewheel.plans.registry import normal_sql, query, uniform_sql
from tidewheel.session import shared_dir
from tidewheel.sources import generators, tables
from tidewheel.sources.versions import VersionedTable

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return tables.parquet_table(spark, folder, name)


def cents(value: str) -> Column:
    """A sum that does not depend on the order of addition."""
    return F.sum(F.col(value).cast("decimal(18,2)")).cast("double")


def to_second(stamp: str) -> Column:
    """A timestamp as text without its fraction; no time zone plays a part."""
    return F.substring(F.col(stamp).cast("string"), 1, 19)


def daily_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Days as rows, event types as columns, summed values in the cells."""
    events = load(spark, folder, "events").withColumn("day", F.to_date("ts").cast("string"))
    return reshape.long_to_wide(events, ["day"], "event_type", EVENT_TYPES, cents("value"))


_WIDE_SQL = "SELECT strftime(ts,'%Y-%m-%d') AS day, " + ", ".join(
    f"sum(value::DECIMAL(18,2)) FILTER (event_type='{kind}')::DOUBLE AS {kind}"
    for kind in EVENT_TYPES
) + " FROM events GROUP BY 1"


@query(
    """SELECT event_id, strftime(ts,'%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
    FROM events"""
)
def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return events.withColumn("ts", to_second("ts"))


@query("SELECT * FROM customer")
def scan_query(spark: SparkSession, folder: str) -> DataFrame:
    return tables.query(
        spark, "SELECT * FROM {customer}", customer=load(spark, folder, "customer")
    )


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    ORDER BY o_orderkey LIMIT 1000"""
)
def scan_limit(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    return tables.limited(orders, "o_orderkey", 1000)


@query(
    """SELECT event_id, user_id, event_type, value FROM events
    WHERE event_type <> 'error' AND event_id % 3 < 2"""
)
def scan_version(spark: SparkSession, folder: str) -> DataFrame:
    """The second version of a table that was written four times."""
    events = load(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    history = VersionedTable(spark, shared_dir(spark, "versions"))
    history.write(events.where("event_type <> 'error' AND event_id % 3 = 0"))
    history.write(events.where("event_type <> 'error' AND event_id % 3 = 1"))
    history.write(events.where("event_id % 3 = 2"))
    history.write(events.limit(0), "overwrite")
    return history.read(version=2)


@query(
    """SELECT user_id, arg_max(event_id, event_id) AS event_id,
      arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value,
      arg_max(version, event_id) AS version
    FROM (SELECT *, dayofmonth(ts)::INT AS version FROM events) WHERE version <= 15
    GROUP BY user_id"""
)
def latest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's last event up to the middle of the month."""
    rows = load(spark, folder, "events").select(
        "user_id", "event_id", "event_type", "value", F.dayofmonth("ts").alias("version")
    )
    return tables.as_of_version(rows, ["user_id"], "version", 15, order=["event_id"])


@query(
    """SELECT l_returnflag, count(*) AS n_rows, sum(CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END
      * l_quantity::DECIMAL(18,2))::DOUBLE AS quantity FROM lineitem GROUP BY 1"""
)
def sink_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table of which one partition was replaced."""
    rows = load(spark, folder, "lineitem").select("l_returnflag", "l_quantity")
    table = VersionedTable(spark, shared_dir(spark, "sink"), ["l_returnflag"])
    table.write(rows)
    table.write(rows.where("l_returnflag = 'R'").withColumn("l_quantity", 2 * F.col("l_quantity")), "partitions")
    return table.read().groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"), cents("l_quantity").alias("quantity"))


@query(
    """SELECT l_returnflag, count(*) AS n_rows, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS quantity,
      sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS price
    FROM lineitem GROUP BY 1"""
)
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_dir(spark, "sink")
    rows = load(spark, folder, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice")
    tables.write_table(rows, path, partition_by=["l_returnflag"])
    return (
        spark.read.parquet(path)
        .groupBy("l_returnflag")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            cents("l_quantity").alias("quantity"),
            cents("l_extendedprice").alias("price"),
        )
    )


@query(
    " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count(*) AS n_rows,
          count(*) - count({name}) AS n_nulls, min({value})::VARCHAR AS min_value,
          max({value})::VARCHAR AS max_value FROM events"""
        for name, value in (
            ("event_id", "event_id"),
            ("ts", "ts"),
            ("user_id", "user_id"),
            ("event_type", "event_type"),
            ("value", "value + 0.0::DOUBLE"),
            ("props", "props"),
        )
    )
)
def dataset_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tables.summary(load(spark, folder, "events")).drop("column_type")


@query(
    """SELECT e.event_type, w.weight, count(*) AS n_rows,
      sum(value::DECIMAL(18,2))::DOUBLE AS total
    FROM events e JOIN (VALUES ('click', 1), ('view', 2), ('signup', 3), ('purchase', 4),
      ('error', 5)) w(event_type, weight) ON e.event_type = w.event_type GROUP BY 1, 2"""
)
def literal_rows(spark: SparkSession, folder: str) -> DataFrame:
    weights = tables.literal_rows(
        spark,
        [("click", 1), ("view", 2), ("signup", 3), ("purchase", 4), ("error", 5)],
        "event_type string, weight int",
    )
    totals = load(spark, folder, "events").groupBy("event_type")
    totals = totals.agg(F.count(F.lit(1)).alias("n_rows"), cents("value").alias("total"))
    return totals.join(F.broadcast(weights), "event_type")


@query(
    f"""SELECT 'list_'||c_custkey AS list_id, pos::INT AS pos,
      (1+floor({uniform_sql('0:list', 'c_custkey', 'pos')}*100))::INT AS x
    FROM customer, range(1, 101) r(pos)"""
)
def gen_lists(spark: SparkSession, folder: str) -> DataFrame:
    keys = spread(load(spark, folder, "customer").select("c_custkey"), "c_custkey")
    return generators.generate_lists(keys, "c_custkey", 100)


@query(
    f"""SELECT series, t::INT AS t, round(sum(move) OVER (PARTITION BY series ORDER BY t
        ROWS UNBOUNDED PRECEDING), 6) AS y
    FROM (SELECT s_suppkey AS series, t,
        {normal_sql('42:walk', 's_suppkey', 't')} + 0.1::DOUBLE*s_nationkey AS move
      FROM supplier, range(100) r(t))"""
)
def gen_walks(spark: SparkSession, folder: str) -> DataFrame:
    drift = F.lit(0.1) * F.col("s_nationkey")
    keys = spread(load(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
    walks = generators.generate_walks(keys, "s_suppkey", 100, drift)
    return walks.withColumn("y", to_places("y", 6))


_FEATURES = [f"f{j}" for j in range(10)]


@query(
    "SELECT o_orderkey, "
    + ", ".join(f"round({f}, 6) AS {f}" for f in _FEATURES)
    + ", round("
    + " + ".join(
        f"100::DOUBLE*{uniform_sql('42:weight', str(j))}*f{j}" for j in range(10)
    )
    + f" + 0.1::DOUBLE*{normal_sql('42:noise', 'o_orderkey')}, 6) AS y"
    + " FROM (SELECT o_orderkey, "
    + ", ".join(f"{normal_sql(f'42:f{j}', 'o_orderkey')} AS f{j}" for j in range(10))
    + " FROM orders)"
)
def gen_regression(spark: SparkSession, folder: str) -> DataFrame:
    keys = spread(load(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    rows = generators.generate_regression(keys, "o_orderkey", 10)
    return rows.withColumns({name: to_places(name, 6) for name in [*_FEATURES, "y"]})


@query(
    """SELECT vec_id, label, (i-1)::INT AS pos, embedding[i]::DOUBLE AS x
    FROM embeddings, range(1, 65) r(i)"""
)
def scan_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.labelled_features(load(spark, folder, "embeddings"), "embedding", "label")
    return reshape.explode_list(rows, ["vec_id", "label"], "embedding")


@query("SELECT event_id, value FROM events")
def project_column(spark: SparkSession, folder: str) -> DataFrame:
    return reshape.project_column(load(spark, folder, "events"), "value", ["event_id"])


@query(
    """UNPIVOT (SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax
      FROM lineitem)
    ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME series VALUE y"""
)
def wide_to_long(spark: SparkSession, folder: str) -> DataFrame:
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return reshape.wide_to_long(
        load(spark, folder, "lineitem"), ["l_orderkey", "l_partkey"], measures
    )


@query(_WIDE_SQL)
def long_to_wide(spark: SparkSession, folder: str) -> DataFrame:
    return daily_by_type(spark, folder)


@query(
    """SELECT vec_id, 64 AS n, (i-1)::INT AS pos, embedding[i]::DOUBLE AS x
    FROM embeddings, range(1, 65) r(i)"""
)
def explode_collect(spark: SparkSession, folder: str) -> DataFrame:
    """Lists to rows, back to lists, and out as rows again."""
    vectors = tables.labelled_features(load(spark, folder, "embeddings"), "embedding", "label")
    rows = reshape.explode_list(vectors, ["vec_id"], "embedding")
    lists = reshape.collect_list_ordered(rows, ["vec_id"]).withColumn("n", F.size("xs"))
    return reshape.explode_list(lists, ["vec_id", "n"], "xs")


@query(
    """SELECT l_orderkey, l_partkey, l_extendedprice::FLOAT::DOUBLE AS l_extendedprice,
      l_discount::FLOAT::DOUBLE AS l_discount FROM lineitem"""
)
def cast_float(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_extendedprice", "l_discount"]
    rows = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", *columns)
    narrow = reshape.cast_float(rows, columns)
    return narrow.withColumns({name: F.col(name).cast("double") for name in columns})


@query(
    "SELECT user_id, to_json({"
    + ", ".join(
        f"'{kind}': coalesce(sum(value::DECIMAL(18,2)) FILTER (event_type='{kind}'), 0)::DOUBLE"
        for kind in EVENT_TYPES
    )
    + "})::VARCHAR AS results FROM events GROUP BY 1"
)
def results_map(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    wide = reshape.long_to_wide(events, ["user_id"], "event_type", EVENT_TYPES, cents("value"))
    results = F.to_json(reshape.results_map(EVENT_TYPES)).alias("results")
    return wide.na.fill(0.0, list(EVENT_TYPES)).select("user_id", results)


@query(
    """SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id
      ROWS UNBOUNDED PRECEDING), 4) AS running_sum FROM events"""
)
def running_sum(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events").select("event_id", "user_id", "value")
    summed = ordering.running_sum(events, ["user_id"], ["event_id"], "value")
    return summed.select("event_id", "user_id", to_places("running_sum", 4).alias("running_sum"))


@query(
    """SELECT event_id, user_id, round(d1, 4) AS d1,
      round(d1 - lag(d1) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS d2
    FROM (SELECT event_id, user_id,
      value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS d1 FROM events)"""
)
def difference(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events").select("event_id", "user_id", "value")
    once = ordering.difference(events, ["user_id"], ["event_id"], "value", 1, "d1")
    twice = ordering.difference(once, ["user_id"], ["event_id"], "d1", 1, "d2")
    return twice.select(
        "event_id", "user_id", to_places("d1", 4).alias("d1"), to_places("d2", 4).alias("d2")
    )


@query(
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id)
      AS ordinal FROM events"""
)
def ordinal(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events").select("event_id", "user_id")
    return ordering.ordinal(events, ["user_id"], ["event_id"])


@query(f"SELECT * FROM ({_WIDE_SQL}) ORDER BY day LIMIT 5")
def head_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ordering.head_rows(daily_by_type(spark, folder), ["day"], 5)


@query(
    """SELECT vec_id, (i-1)::INT AS pos,
      round((e[i]-list_min(e))/(list_max(e)-list_min(e)), 6) AS x
    FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings ORDER BY vec_id LIMIT 1),
      range(1, 6) r(i)"""
)
def slice_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first five scaled elements of the first list."""
    vectors = load(spark, folder, "embeddings").select(
        "vec_id", minmax_list(F.col("embedding").cast("array<double>")).alias("xs")
    )
    first = ordering.slice_first(vectors, ["vec_id"], "xs", 5)
    return reshape.explode_list(first, ["vec_id"], "xs").withColumn("x", to_places("x", 6))


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
    ORDER BY o_orderkey LIMIT 1"""
)
def first_item(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"
    )
    return ordering.head_rows(orders, ["o_orderkey"], 1)


@query(
    """SELECT l_returnflag, i::INT AS pos, round(pow(10.0::DOUBLE, lo+i*((hi-lo)/29)), 4) AS x
    FROM (SELECT l_returnflag, log10(min(l_extendedprice)) AS lo, log10(max(l_extendedprice)) AS hi
      FROM lineitem GROUP BY 1), range(30) r(i)"""
)
def logspace(spark: SparkSession, folder: str) -> DataFrame:
    """30 values, even in the exponent, over the range of prices of each return flag."""
    ranges = load(spark, folder, "lineitem").groupBy("l_returnflag")
    ranges = ranges.agg(
        F.log10(F.min("l_extendedprice")).alias("low"),
        F.log10(F.max("l_extendedprice")).alias("high"),
    )
    spaced = ranges.withColumn("xs", logspace_values(F.col("low"), F.col("high"), 30))
    rows = reshape.explode_list(spaced, ["l_returnflag"], "xs")
    return rows.withColumn("x", to_places("x", 4))


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber,
      round(sin(l_quantity), 6) AS sine, round(ln(l_extendedprice), 6) AS logarithm,
      abs(l_discount - l_tax) AS distance, round(pow(l_quantity, 2), 6) AS square,
      round(pi() * l_tax, 6) AS angle, greatest(l_tax - 0.04::DOUBLE, 0) AS rectified,
      round(-l_quantity / nullif(l_discount, 0), 6) AS ratio
    FROM lineitem"""
)
def scalar_math(spark: SparkSession, folder: str) -> DataFrame:
    quantity, discount, tax = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        to_places(F.sin(quantity), 6).alias("sine"),
        to_places(F.ln("l_extendedprice"), 6).alias("logarithm"),
        F.abs(discount - tax).alias("distance"),
        to_places(F.pow(quantity, F.lit(2)), 6).alias("square"),
        to_places(F.pi() * tax, 6).alias("angle"),
        F.greatest(tax - F.lit(0.04), F.lit(0.0)).alias("rectified"),
        to_places(F.try_divide(-quantity, discount), 6).alias("ratio"),
    )


@query(
    """SELECT vec_id, len(e)::INT AS n, round(list_sum(e), 6) AS total,
      round(list_avg(e), 6) AS mean, round(e[1], 6) AS first_value,
      round(list_sum(e[1:5]), 6) AS first_five,
      round(list_sum(list_transform(e, lambda x: x*x)), 6) AS norm,
      round(list_sum(list_transform(range(1, 65), lambda i: e[i]*i)), 6) AS moment
    FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)"""
)
def array_funcs(spark: SparkSession, folder: str) -> DataFrame:
    xs = F.col("embedding").cast("array<double>")
    places = F.sequence(F.lit(1), F.size("xs"))
    vectors = load(spark, folder, "embeddings").select("vec_id", xs.alias("xs"))
    return vectors.select(
        "vec_id",
        F.size("xs").alias("n"),
        to_places(total(F.col("xs")), 6).alias("total"),
        to_places(mean_list(F.col("xs")), 6).alias("mean"),
        to_places(F.element_at("xs", 1), 6).alias("first_value"),
        to_places(total(F.slice("xs", 1, 5)), 6).alias("first_five"),
        to_places(total(F.transform("xs", lambda x: x * x)), 6).alias("norm"),
        to_places(total(F.zip_with("xs", places, lambda x, i: x * i)), 6).alias("moment"),
    )

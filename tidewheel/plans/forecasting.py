"""Queries on forecasts and run tracking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions.rounding import to_places
from tidewheel.operators import forecast, tracking
from tidewheel.plans.data import cents, load, to_second
from tidewheel.plans.registry import query
from tidewheel.session import shared_dir

EXPERIMENT = "sales_forecast"
ORDER = "(1, 1, 1)"



def _filled_sql(totals: str, every: str) -> str:
    """``totals`` with a 0 for each period of a series' calendar that has no row."""
    return f"""(SELECT series, period, sum(y) AS y FROM (SELECT * FROM {totals}
      UNION ALL SELECT series, unnest(generate_series(min(period), max(period), INTERVAL {every}))::DATE, 0
      FROM {totals} GROUP BY 1) GROUP BY 1, 2)"""


_DAILY_SQL = _filled_sql(
    """(SELECT event_type AS series, ts::DATE AS period,
      sum(value::DECIMAL(18,2))::DOUBLE AS y FROM events GROUP BY 1, 2)""",
    "1 DAY",
)

_MONTHLY_SQL = _filled_sql(
    """(SELECT p_brand AS series, date_trunc('month', l_shipdate)::DATE AS period,
      sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS y
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
    "1 MONTH",
)


def _css_sql(totals: str) -> str:
    """The grid fit as list reductions; ties by rounded sum, phi, theta."""
    e = "(w - phi*acc.w - theta*acc.e)"
    return f"""(SELECT series, phi, theta, ys[-1] + phi*state.w + theta*state.e AS forecast
      FROM (SELECT series, ys, phi, theta, list_reduce(ws, lambda acc, w:
          {{'e': {e}, 'sse': acc.sse + {e}*{e}, 'w': w}},
          {{'e': 0.0::DOUBLE, 'sse': 0.0::DOUBLE, 'w': 0.0::DOUBLE}}) AS state
        FROM (SELECT series, ys, list_transform(range(2, len(ys)+1), lambda i: ys[i]-ys[i-1]) AS ws
          FROM (SELECT series, list(y ORDER BY period) AS ys FROM {totals} GROUP BY 1)),
        (SELECT (i//39 - 19)/20::DOUBLE AS phi, (i%39 - 19)/20::DOUBLE AS theta
          FROM range(1521) r(i)))
      QUALIFY row_number() OVER (PARTITION BY series
        ORDER BY round(state.sse, 4), phi, theta) = 1)"""


def daily_series(spark: SparkSession, folder: str) -> DataFrame:
    totals = forecast.totals_by_period(
        load(spark, folder, "events").withColumnRenamed("event_type", "series"),
        ["series"],
        F.to_date("ts"),
        F.col("value"),
        exact="decimal(18,2)",
        every="1 day",
    )
    return forecast.series_lists(totals, ["series"])


def monthly_series(spark: SparkSession, folder: str) -> DataFrame:
    """Price per brand and month.

    A small part table is broadcast; a large one is joined by shuffles that
    adaptive execution splits where one part is hot.
    """
    lines = load(spark, folder, "lineitem").select("l_partkey", "l_shipdate", "l_extendedprice")
    part = load(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("series"))
    totals = forecast.totals_by_period(
        lines.join(part, lines.l_partkey == part.p_partkey),
        ["series"],
        F.trunc(F.col("l_shipdate").cast("date"), "month"),
        F.col("l_extendedprice"),
        exact="decimal(18,2)",
        every="1 month",
    )
    return forecast.series_lists(totals, ["series"])


@query(
    f"SELECT series, phi, theta, round(forecast, 4) AS forecast FROM {_css_sql(_DAILY_SQL)}"
)
def arima_css(spark: SparkSession, folder: str) -> DataFrame:
    fitted = daily_series(spark, folder).withColumn("fit", forecast.css_forecast(F.col("ys")))
    return fitted.select(
        "series", "fit.phi", "fit.theta", to_places("fit.forecast", 4).alias("forecast")
    )


@query(
    f"SELECT series, phi, theta, round(forecast, 4) AS forecast FROM {_css_sql(_MONTHLY_SQL)}"
)
def forecast_many(spark: SparkSession, folder: str) -> DataFrame:
    lists = monthly_series(spark, folder)
    fitted = forecast.forecast_series(lists, spark.sparkContext.defaultParallelism)
    return fitted.withColumn("forecast", to_places("forecast", 4))


@query()
def forecast_order(spark: SparkSession, folder: str) -> DataFrame:
    lists = monthly_series(spark, folder)
    fitted = forecast.forecast_order(lists, (2, 1, 1), spark.sparkContext.defaultParallelism)
    return fitted.withColumn("forecast", to_places("forecast", 2))


@query(
    f"""SELECT series, round(ys[-1] + phi*ws[-1], 2) AS forecast, 'ok' AS status
    FROM (SELECT series, ys, ws, list_dot_product(ws[2:], ws[:-2]) / list_dot_product(ws[:-2], ws[:-2])
        AS phi
      FROM (SELECT series, ys, list_transform(range(2, len(ys)+1), lambda i: ys[i]-ys[i-1]) AS ws
        FROM (SELECT series, list(y ORDER BY period) AS ys FROM {_MONTHLY_SQL} GROUP BY 1)))"""
)
def forecast_order_ar(spark: SparkSession, folder: str) -> DataFrame:
    """Order (1, 1, 0), whose fit is a ratio of sums."""
    lists = monthly_series(spark, folder)
    fitted = forecast.forecast_order(lists, (1, 1, 0), spark.sparkContext.defaultParallelism)
    return fitted.withColumn("forecast", to_places("forecast", 2))


@query(
    f"""WITH d AS (SELECT series, ys, list_transform(range(2, len(ys)+1), lambda i: ys[i]-ys[i-1]) AS ws
      FROM (SELECT series, list(y ORDER BY period) AS ys FROM {_MONTHLY_SQL} GROUP BY 1)),
    w AS (SELECT series, ys, list_transform(range(2, len(ws)+1), lambda i: ws[i]-ws[i-1]) AS ws, ws AS once FROM d),
    l AS (SELECT *, list_transform(range(1, len(ws)+1), lambda i: if(i > 1, ws[i-1], 0)) AS w1,
        list_transform(range(1, len(ws)+1), lambda i: if(i > 2, ws[i-2], 0)) AS w2 FROM w),
    s AS (SELECT *, list_dot_product(w1, w1) AS s11, list_dot_product(w1, w2) AS s12, list_dot_product(w2, w2) AS s22,
        list_dot_product(ws, w1) AS b1, list_dot_product(ws, w2) AS b2 FROM l)
    SELECT series, round(2 * ys[-1] - ys[-2] + (s22 * b1 - s12 * b2) / (s11 * s22 - s12 * s12) * ws[-1]
        + (s11 * b2 - s12 * b1) / (s11 * s22 - s12 * s12) * ws[-2], 2) AS forecast, 'ok' AS status
    FROM s"""
)
def forecast_order_ar2(spark: SparkSession, folder: str) -> DataFrame:
    """Order (2, 2, 0), whose fit solves two linear equations."""
    lists = monthly_series(spark, folder)
    fitted = forecast.forecast_order(lists, (2, 2, 0), spark.sparkContext.defaultParallelism)
    return fitted.withColumn("forecast", to_places("forecast", 2))


@query(
    f"""WITH fits AS (SELECT md5('{EXPERIMENT}/'||series) AS run_id, * FROM {_css_sql(_DAILY_SQL)})
    SELECT run_id, series, 'param' AS kind, 'order' AS key, '{ORDER}' AS text_value,
      NULL::DOUBLE AS number_value FROM fits
    UNION ALL SELECT run_id, series, 'metric', 'forecast_value', NULL, round(forecast, 4) FROM fits"""
)
def forecast_logged(spark: SparkSession, folder: str) -> DataFrame:
    """Forecasts written to the parameter and metric tables, one run per series."""
    fitted = forecast.forecast_series(daily_series(spark, folder))
    run = tracking.run_id(EXPERIMENT, F.col("series"))
    params = tracking.log_params(fitted.select("series"), run, {"order": F.lit(ORDER)})
    names = fitted.select(run.alias("run_id"), "series")
    metrics = tracking.log_metrics(
        fitted, run, F.col("series"), {"forecast_value": to_places("forecast", 4)}
    )
    return (
        params.join(names, "run_id")
        .select(
            "run_id",
            "series",
            F.lit("param").alias("kind"),
            "key",
            F.col("value").alias("text_value"),
            F.lit(None).cast("double").alias("number_value"),
        )
        .unionByName(
            metrics.select(
                "run_id",
                "series",
                F.lit("metric").alias("kind"),
                "key",
                F.lit(None).cast("string").alias("text_value"),
                F.col("value").alias("number_value"),
            )
        )
    )


def _user_totals(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    return events.groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n_points"), cents("value").alias("total")
    )


_USER_TOTALS_SQL = f"""(SELECT md5('{EXPERIMENT}/'||event_type||'/'||user_id) AS run_id, user_id,
      count(*) AS n_points, sum(value::DECIMAL(18,2))::DOUBLE AS total
    FROM events GROUP BY event_type, user_id)"""


@query(
    f"""SELECT run_id, 'order' AS key, '{ORDER}' AS value FROM {_USER_TOTALS_SQL}
    UNION ALL SELECT run_id, 'n_points', n_points::VARCHAR FROM {_USER_TOTALS_SQL}"""
)
def run_params(spark: SparkSession, folder: str) -> DataFrame:
    run = tracking.run_id(EXPERIMENT, F.col("event_type"), F.col("user_id"))
    params = {"order": F.lit(ORDER), "n_points": F.col("n_points")}
    return tracking.log_params(_user_totals(spark, folder), run, params)


@query(
    f"""SELECT run_id, user_id::VARCHAR AS series, 'total' AS key, total AS value,
      0::BIGINT AS step FROM {_USER_TOTALS_SQL}
    UNION ALL SELECT run_id, user_id::VARCHAR, 'mean', round(total / n_points, 6), 0
    FROM {_USER_TOTALS_SQL}"""
)
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    run = tracking.run_id(EXPERIMENT, F.col("event_type"), F.col("user_id"))
    metrics = {"total": F.col("total"), "mean": to_places(F.col("total") / F.col("n_points"), 6)}
    return tracking.log_metrics(_user_totals(spark, folder), run, F.col("user_id"), metrics)


_STAMP = "'%Y-%m-%d %H:%M:%S'"


@query(
    f"""SELECT md5('{EXPERIMENT}/'||event_type) AS run_id, NULL AS parent_run_id,
      '{EXPERIMENT}' AS experiment, event_type AS name, 'parent' AS mode,
      strftime(min(ts), {_STAMP}) AS started_at, strftime(max(ts), {_STAMP}) AS ended_at
    FROM events GROUP BY event_type
    UNION ALL SELECT md5('{EXPERIMENT}/'||event_type||'/'||user_id), md5('{EXPERIMENT}/'||event_type),
      '{EXPERIMENT}', event_type||'/'||user_id, 'nested',
      strftime(min(ts), {_STAMP}), strftime(max(ts), {_STAMP})
    FROM events GROUP BY event_type, user_id"""
)
def run_tree(spark: SparkSession, folder: str) -> DataFrame:
    events = load(spark, folder, "events")
    runs = tracking.run_tree(events, EXPERIMENT, "event_type", "user_id", F.col("ts"), F.col("ts"))
    stamps = {name: to_second(name) for name in ("started_at", "ended_at")}
    return runs.withColumns(stamps)


@query(
    """WITH runs AS (SELECT event_type AS mode, user_id,
        date_diff('microsecond', min(ts), max(ts)) AS took FROM events GROUP BY 1, 2),
      spent AS (SELECT mode, count(*) AS n_runs, sum(took)::DOUBLE AS took FROM runs GROUP BY 1)
    SELECT mode, n_runs, round(took/1e6, 4) AS duration_s,
      round((SELECT took FROM spent WHERE mode = 'view')/took, 6) AS speed_up FROM spent"""
)
def run_durations(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's events of a type are one run of that mode."""
    events = load(spark, folder, "events")
    runs = tracking.runs_from(
        events, EXPERIMENT, ["event_type", "user_id"], F.col("event_type"), F.col("ts"), F.col("ts")
    )
    spent = tracking.run_durations(runs, "view")
    return spent.withColumns(
        {"duration_s": to_places("duration_s", 4), "speed_up": to_places("speed_up", 6)}
    )


@query(
    f"""SELECT md5('{EXPERIMENT}/'||user_id) AS run_id, event_type AS key,
      arg_max(value, event_id) AS value, max(event_id) AS step FROM events GROUP BY user_id, event_type"""
)
def latest_metric(spark: SparkSession, folder: str) -> DataFrame:
    """Events as metric reports of their user's run."""
    metrics = load(spark, folder, "events").select(
        tracking.run_id(EXPERIMENT, F.col("user_id")).alias("run_id"),
        F.col("event_type").alias("key"),
        "value",
        F.col("event_id").alias("step"),
    )
    return tracking.latest_metric(metrics)


@query(
    f"""SELECT 'param' AS kind, run_id, 'order' AS key, '{ORDER}' AS text_value, NULL::DOUBLE AS number_value
      FROM {_USER_TOTALS_SQL}
    UNION ALL SELECT 'param', run_id, 'n_points', n_points::VARCHAR, NULL FROM {_USER_TOTALS_SQL}
    UNION ALL SELECT 'metric', run_id, 'total', NULL, total FROM {_USER_TOTALS_SQL}
    UNION ALL SELECT 'metric', run_id, 'mean', NULL, round(total / n_points, 6) FROM {_USER_TOTALS_SQL}"""
)
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Params and metrics appended to the run log, one commit twice, and read back."""
    store = tracking.RunStore(spark, shared_dir(spark, "runs"))
    params, metrics = run_params(spark, folder), run_metrics(spark, folder)
    store.append("params", params.where("key = 'order'"), "orders")
    store.append("params", params.where("key <> 'order'"), "points")
    store.append("metrics", metrics, "metrics")
    store.append("metrics", metrics, "metrics")
    text = F.col("value").cast("string").alias("text_value")
    none = F.lit(None).cast("double").alias("number_value")
    logged = store.read("params").select(F.lit("param").alias("kind"), "run_id", "key", text, none)
    number = store.read("metrics").select(
        F.lit("metric").alias("kind"), "run_id", "key", F.lit(None).cast("string").alias("text_value"), F.col("value").alias("number_value")
    )
    return logged.unionByName(number)

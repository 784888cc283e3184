import json
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import assert_same_rows, plan_of, rounded
from tidewheel.operators import fanout, prompts, scale, tracking
from tidewheel.operators.ordering import Layout
from tidewheel.plans import searching
from tidewheel.sources.versions import VersionedTable


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, f"question {i} é \"quoted\"") for i in range(30)]
    df = spark.createDataFrame(rows, "n int, prompt string")
    return df.withColumn("request", prompts.chat_request(F.col("prompt"), "m"))


def test_request_body(table):
    body = json.loads(table.where("n = 3").first().request)
    assert body == {
        "messages": [
            {"role": "system", "content": "You are an AI assistant"},
            {"role": "user", "content": 'question 3 é "quoted"'},
        ],
        "model": "m",
        "max_tokens": 256,
    }


def test_offline_answers(table):
    done = prompts.batch_complete(table, parallelism=3)
    text = done.select("n", "error", prompts.response_text(F.col("response")).alias("t"))
    rows = {r.n: (r.t, r.error) for r in text.collect()}
    assert len(rows) == 30 and rows[3] == ('You said: question 3 é "quoted"', None)


def test_a_failing_prompt_keeps_its_place(table):
    def picky(requests):
        if any("question 7 " in r for r in requests):
            raise RuntimeError("no")
        return ["fine"] * len(requests)

    rows = {r.n: r for r in prompts.batch_complete(table.coalesce(1), complete=picky).collect()}
    assert len(rows) == 30
    assert rows[7].response is None and rows[7].error == "RuntimeError: no"
    assert all(r.response == "fine" and r.error is None for n, r in rows.items() if n != 7)


def test_missing_responses_are_errors(table):
    rows = prompts.batch_complete(table, complete=lambda requests: []).collect()
    assert len(rows) == 30 and all("0 responses" in r.error for r in rows)


def counting(folder):
    """A completion function that leaves a file for every request; prompts with a 7 fail
    as long as there is no file named ``mended``."""

    def complete(requests):
        for request in requests:
            (folder / f"asked-{uuid.uuid4().hex}").write_text(request)
        if any("question 7 " in r for r in requests) and not (folder / "mended").exists():
            raise RuntimeError("no")
        return [f"answer to {len(r)}" for r in requests]

    return complete, lambda: len(list(folder.glob("asked-*")))


def test_a_filter_asks_no_row_twice(table, tmp_path):
    complete, asked = counting(tmp_path)
    done = prompts.batch_complete(table.where("n <> 7").coalesce(2), complete=complete)
    assert done.where("error IS NULL").select("n", "response").count() == 29
    assert asked() == 29


def test_answers_are_kept(spark, table, tmp_path):
    complete, asked = counting(tmp_path)
    store = VersionedTable(spark, str(tmp_path / "answers"))
    twice = table.unionByName(table).unionByName(table.limit(1).withColumn("request", F.lit(None).cast("string")))
    some = twice.where("n < 5").coalesce(1)
    first = prompts.answered(some, store, complete=complete)
    assert asked() == 5 and first.where("response IS NOT NULL").count() == 10
    assert first.where("request IS NULL AND response IS NULL AND error IS NULL").count() == 1
    again = prompts.answered(twice.coalesce(1), store, complete=lambda r: [complete([x])[0] for x in r])
    rows = again.collect()
    assert len(rows) == 61 and sum(r.error is not None for r in rows) == 2
    before = asked()
    (tmp_path / "mended").write_text("")
    mended = prompts.answered(twice.coalesce(1), store, complete=complete).collect()
    assert asked() == before + 1 and all(r.error is None for r in mended)
    assert {r.n for r in mended if r.response} == set(range(30))


def test_report_is_numbered_in_input_order(table):
    for layout in (Layout(), Layout(rows_per_chunk=7)):
        numbered = prompts.numbered_prompts(table.repartition(4), ["n"], layout=layout)
        done = prompts.batch_complete(numbered, complete=lambda requests: ["ok"] * len(requests))
        lines = prompts.prompt_report(done).collect()
        assert [r.ordinal for r in lines] == list(range(1, 31))
        assert lines[4].prompt_line.startswith("Prompt 5: question 4")
        assert lines[4].response_line == "Response 5: ok"


def test_lists_by_function_and_by_expression(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 4.0]), (2, [5.0, 5.0]), (3, [])], "id int, xs array<double>")
    both = fanout.process_lists(F.col("xs"), ["standard", "minmax"])
    rows = scale.minmax_array(scale.standard_array(df, "xs", "z"), "xs", out="u")
    for row in rows.withColumn("both", both).collect():
        if row.xs:
            assert row.both.standard == pytest.approx(row.z) and row.both.minmax == pytest.approx(row.u)
        else:
            assert row.both is None
    doubled = df.select(fanout.map_lists(F.col("xs"), lambda x: x * 2).alias("d"))
    assert [r.d for r in doubled.collect()] == [[2, 4, 8], [10, 10], []]
    top = df.select(fanout.score_lists(F.col("xs"), lambda x: float(np.max(x)) if len(x) else None).alias("m"))
    assert [r.m for r in top.collect()] == [4, 5, None]


def test_null_items_stay_null(spark):
    df = spark.createDataFrame([([1.0, None, 3.0],), ([None, None],), (None,)], "xs array<double>")
    both = fanout.process_lists(F.col("xs"), ["standard", "minmax"])
    scaled = fanout.map_lists(F.col("xs"), lambda x: fanout.ListProcessor(x).minmax())
    rows = df.select(both.alias("both"), scaled.alias("u")).collect()
    assert rows[0].both.standard == [-1, None, 1] and rows[0].both.minmax == rows[0].u == [0, None, 1]
    assert rows[1].both.minmax == rows[1].u == [None, None]
    assert rows[2].both is None and rows[2].u is None


def test_trial_function(spark, folder):
    trials = searching.objective_trials(spark, folder)
    scored = fanout.map_trials(trials, searching.objective, ["score"], partitions=3)
    many = fanout.map_trial_batches(trials, searching.objective_of_many, ["score"], partitions=2)
    assert_same_rows(rounded(scored), rounded(many))
    assert fanout.map_trial_batches(trials.limit(0), searching.objective_of_many, ["score"]).count() == 0
    assert scored.count() == trials.count()
    assert scored.where("score IS NULL").count() == 0


def test_means_by_batches(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("x"))
    expected = df.groupBy("k").agg(F.avg("x").alias("mean"))
    assert_same_rows(fanout.mean_by_batches(df.repartition(6), ["k"], "x"), expected)


def test_means_keep_large_keys_and_nan(spark):
    rows = [(9007199254740993, 1.0), (9007199254740992, 3.0), (None, 5.0), (1, float("nan")), (2, None)]
    df = spark.createDataFrame(rows, "k long, x double").coalesce(1)
    means = {r.k: r["mean"] for r in fanout.mean_by_batches(df, ["k"], "x").collect()}
    assert np.isnan(means.pop(1))
    assert means == {9007199254740993: 1.0, 9007199254740992: 3.0, None: 5.0, 2: None}


def test_run_ids_differ_with_nulls_and_slashes(spark):
    rows = [("a", None), ("a", "\\N"), ("a/b", "c"), ("a", "b/c"), ("a\\", "b"), ("a", "\\b"), (None, "a")]
    df = spark.createDataFrame(rows, "p string, c string")
    pair, single = tracking.run_id("e", F.col("p"), F.col("c")), tracking.run_id("e", F.col("p"))
    ids = [x for row in df.select(pair, single).collect() for x in row]
    assert len(set(ids)) == len(rows) + 4


def test_run_store(spark, tmp_path):
    store = tracking.RunStore(spark, str(tmp_path))
    results = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "series string, forecast double")
    run = tracking.run_id("exp", F.col("series"))
    params = tracking.log_params(results, run, {"order": F.lit("(1, 1, 1)")})
    losses = spark.createDataFrame([("a", 1, 9.0), ("a", 2, 4.0)], "series string, epoch int, loss double")
    metrics = tracking.log_metrics(losses, run, F.col("series"), {"loss": F.col("loss")}, F.col("epoch"))
    for _ in range(2):
        store.append("params", params)
        store.append("metrics", metrics)
    assert store.read("params").count() == 2
    latest = tracking.latest_metric(store.read("metrics")).first()
    assert latest.value == 4.0 and latest.step == 2
    assert plan_of(tracking.latest_metric(store.read("metrics"))).count("SortAggregate") == 0


def test_run_tree_and_durations(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES ('m', 'a', TIMESTAMP_NTZ '2024-01-01 00:00:00'),
        ('m', 'a', TIMESTAMP_NTZ '2024-01-01 00:00:10'), ('m', 'b', TIMESTAMP_NTZ '2024-01-01 00:00:05')
        AS t(p, s, at)"""
    )
    tree = tracking.run_tree(rows, "e", "p", "s", F.col("at"), F.col("at"))
    parent = tree.where("parent_run_id IS NULL").first()
    children = tree.where("parent_run_id IS NOT NULL").collect()
    assert parent.name == "m" and {c.name for c in children} == {"m/a", "m/b"}
    assert {c.parent_run_id for c in children} == {parent.run_id}
    assert tuple(tree.columns) == tracking.RUN_COLUMNS
    runs = spark.sql(
        """SELECT * FROM VALUES ('one', TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:30'),
        ('many', TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:10')
        AS t(mode, started_at, ended_at)"""
    )
    spent = {r["mode"]: (r.duration_s, r.speed_up) for r in tracking.run_durations(runs, "one").collect()}
    assert spent == {"one": (30.0, 1.0), "many": (10.0, 3.0)}


def test_timed_runs(spark):
    runs = []
    for mode, partitions in (("one", 1), ("many", 4)):
        rows = spark.range(0, 1000, 1, partitions)
        result, run = tracking.timed(spark, "e", "sum", mode, lambda: rows.agg(F.sum("id")).first()[0])
        assert result == 499500
        runs.append(run)
    spent = tracking.run_durations(runs[0].unionByName(runs[1]), "one")
    assert {r["mode"] for r in spent.where("duration_s > 0 AND speed_up > 0").collect()} == {"one", "many"}

"""What the co-training of ``op1_quality`` moves between tasks."""

import pytest

from tidewheel.llm import quality


def test_texts_are_not_shuffled_to_leave_out_labelled_ones(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, f"some words of text {i % 7} " * (1 + i % 5), "a", "en") for i in range(120)],
        "doc_id long, text string, source string, lang string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 120, 2)] + [(1, 1), (3, 0)], "doc_id long, quality int")
    labels = labels.withColumn("quality", (labels.doc_id % 3 == 0).cast("int"))
    seen, plain = [], quality.staged
    monkeypatch.setattr(quality, "staged", lambda df, purpose: seen.append(df) or plain(df, purpose))
    assert quality.fit(docs, labels, rounds=1) is not None
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    # scores, which are small, meet the ids of labelled rows; texts are below the scoring
    assert plan.index("Join LeftAnti") < plan.index("MapInArrow")
    scored = {row["doc_id"] for row in seen[0].select("doc_id").collect()}
    marked = {row["doc_id"] for row in labels.collect()}
    held = {row["doc_id"] for row in docs.where(quality.held_out(docs.doc_id)).collect()}
    assert scored == set(range(120)) - (marked - held) - held

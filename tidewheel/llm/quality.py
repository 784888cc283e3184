"""Quality by co-training: a text-content view and a page-metadata view teach each other.

The content view averages hashed subword embeddings of the whole text under a linear
softmax; the metadata view is a logistic model of source, language, size and line
layout. Both start from the same labelled rows. In every round both views score all
documents without a label; a histogram of the scores over the corpus gives the thresholds
beyond which a view is sure, and what it is sure of becomes training rows of the other
view. In the end both views are calibrated together on labelled rows that neither
has seen, and the combination scores all documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import held_out, put, release, sample_rows, schema_with, staged, text_blocks
from tidewheel.llm.language import subwords, text_logits, train
from tidewheel.llm.toxicity import newton

LABELLED_ROWS = 3_000
"""Labelled rows that the views start from, about; all of them if there are fewer."""
PSEUDO_ROWS = 1_000
"""Pseudo-labelled rows that a view is trained on in a round, about: a sample of those that
the other view is sure of."""
ROUNDS = 3
SURE_SHARE = 0.05
"""The share of all unlabelled documents that a view is sure of, divided as the labels are."""
RATE = 0.1
"""Learning rate of the content view; the rows that a view is sure of are much alike, and
a batch of them moves the weights far."""
SLOTS = 16
BINS_PER_LOGIT = 64


@dataclass
class Model:
    table: np.ndarray
    layout: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    both: np.ndarray

    def scores(self, content: np.ndarray, layout: np.ndarray) -> np.ndarray:
        z = np.stack([np.ones(len(content)), content, linear(layout, self.layout, self.mean, self.scale)], 1)
        return 1 / (1 + np.exp(-np.clip(z @ self.both, -30, 30)))


def linear(x: np.ndarray, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale @ w[1:] + w[0], -30, 30)


def layout_of(text: str, source: str | None, lang: str | None) -> list[float]:
    """The metadata view: size, lines, and hashed source and language."""
    lines = [len(line) for line in text.split("\n")]
    size = len(text)
    out = [
        np.log1p(size),
        np.log1p(len(lines)),
        np.log1p(max(lines)),
        np.log1p(size / len(lines)),
        sum(n < 40 for n in lines) / len(lines),
    ]
    for value in (source, lang):
        slots = [0.0] * SLOTS
        if value is not None:
            slots[zlib.crc32(value.encode("utf-8", "replace")) % SLOTS] = 1.0
        out.extend(slots)
    return out


@dataclass
class Rows:
    """Described documents: subword buckets with their shares, and the layout of each."""

    ids: list[np.ndarray]
    shares: list[np.ndarray]
    layout: np.ndarray
    label: np.ndarray

    def take(self, rows) -> Rows:
        picked = np.arange(len(self.ids))[rows].tolist()
        return Rows([self.ids[i] for i in picked], [self.shares[i] for i in picked], self.layout[picked], self.label[picked])

    def __add__(self, other: Rows) -> Rows:
        return Rows(
            self.ids + other.ids,
            self.shares + other.shares,
            np.concatenate([self.layout, other.layout]),
            np.concatenate([self.label, other.label]),
        )


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, shares, layouts = [], [], []
        columns = (batch.column(name).to_pylist() for name in ("text", "source", "lang"))
        for text, source, lang in zip(*columns, strict=True):
            buckets, _ = subwords([text or ""])
            found, counts = np.unique(buckets, return_counts=True)
            ids.append(found.astype(np.int32))
            shares.append((counts / counts.sum()).astype(np.float32))
            layouts.append(layout_of(text or "", source, lang))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "label": batch.column("label"),
                "ids": pa.array(ids, pa.list_(pa.int32())),
                "shares": pa.array(shares, pa.list_(pa.float32())),
                "layout": pa.array(layouts, pa.list_(pa.float64())),
            }
        )


def described(docs: DataFrame, marks: DataFrame) -> Rows:
    """The documents that ``marks`` (doc_id, label) names, one for each id: of those that
    share an id the one whose text has the smallest hash. ``marks`` is a bounded sample."""
    one = F.min_by(F.struct("text", "source", "lang"), F.struct(F.xxhash64("text"), "source", "lang")).alias("row")
    rows = docs.join(F.broadcast(marks), "doc_id").groupBy("doc_id", "label").agg(one)
    kinds = "doc_id long, label int, ids array<int>, shares array<float>, layout array<double>"
    table = rows.select("doc_id", "label", "row.*").mapInArrow(_described, kinds).toArrow().sort_by("doc_id")
    layout = np.array(table.column("layout").to_pylist(), float).reshape(table.num_rows, 5 + 2 * SLOTS)
    ids, shares = ([np.asarray(x.values) for x in table.column(name)] for name in ("ids", "shares"))
    return Rows(ids, shares, layout, np.array(table.column("label").to_pylist(), int))


@dataclass
class Views:
    """Both views as trained so far, and how layouts are scaled."""

    table: np.ndarray
    layout: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def content_of(self, rows: Rows) -> np.ndarray:
        gap = self.table[:, 1] - self.table[:, 0]
        return np.array([share @ gap[ids] for ids, share in zip(rows.ids, rows.shares, strict=True)], float)

    def layout_of(self, rows: Rows) -> np.ndarray:
        return linear(rows.layout, self.layout, self.mean, self.scale)

    def of_texts(self, texts: list[str], places: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        logits = text_logits(texts, self.table)
        layout = np.array([layout_of(text, *place) for text, place in zip(texts, places, strict=True)])
        return logits[:, 1] - logits[:, 0], linear(layout, self.layout, self.mean, self.scale)


def train_views(content: Rows, layout: Rows, mean: np.ndarray, scale: np.ndarray) -> Views:
    embed, top = train(content.ids, content.shares, content.label, 2, rate=RATE)
    z = np.hstack([np.ones((len(layout.label), 1)), (layout.layout - mean) / scale])
    return Views((embed @ top).astype(np.float32), newton(z, layout.label.astype(float), 1e-2), mean, scale)


def view_scores(docs: DataFrame, views: Views) -> DataFrame:
    """(doc_id, content, layout): the logits of both views for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch):
                texts = [text or "" for text in block.column("text").to_pylist()]
                places = zip(block.column("source").to_pylist(), block.column("lang").to_pylist(), strict=True)
                content, layout = views.of_texts(texts, list(places))
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": block.column("doc_id"), "content": content.astype(float), "layout": layout}
                )

    return docs.mapInArrow(run, "doc_id long, content double, layout double")


def sure_limits(scores: DataFrame, view: str, share: float, good: float) -> tuple[float, float]:
    """The limits that ``share`` of all scores lie beyond: above the upper one a part of
    ``good`` of them, below the lower one the rest, and none on the wrong side of 0. They
    are edges of a histogram over all documents, so reruns agree."""
    step = F.floor(F.col(view) * BINS_PER_LOGIT).cast("int").alias("bin")
    bins = sorted((row["bin"], row["count"]) for row in scores.groupBy(step).count().collect())
    edges, counts = np.array([x for x, _ in bins]), np.array([n for _, n in bins])
    total = counts.sum()
    below, above = np.cumsum(counts), np.cumsum(counts[::-1])[::-1]
    low = edges[below <= share * (1 - good) * total]
    high = edges[above <= share * good * total]
    return (
        min(0.0, (low.max() + 1) / BINS_PER_LOGIT) if len(low) else -np.inf,
        max(0.0, high.min() / BINS_PER_LOGIT) if len(high) else np.inf,
    )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    labelled_rows: int = LABELLED_ROWS,
    pseudo_rows: int = PSEUDO_ROWS,
    rounds: int = ROUNDS,
    sure_share: float = SURE_SHARE,
) -> Model | None:
    """Learns from labelled rows outside the held-out fifth and from all unlabelled documents.

    What comes to the driver is bounded by ``labelled_rows`` and ``pseudo_rows``; scores and
    thresholds are of all unlabelled documents. Rows without an id, and labels that are
    null or neither 0 nor 1, teach nothing. Null and empty texts count as texts without
    subwords. ``None`` without both classes.
    """
    marks = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").cast("int").alias("label"))
    )
    docs = docs.select("doc_id", "text", "source", "lang")
    known = described(docs, sample_rows(marks, F.col("doc_id"), labelled_rows))
    if not {0, 1} <= set(known.label.tolist()):
        return None
    named = F.col("doc_id").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(True))
    outside = docs.where(named)
    marked = marks.select("doc_id")

    def exchange(views: Views, good: float) -> tuple[Rows, Rows]:
        """What the content view and the layout view are sure of."""
        # texts stay where they are: labelled ones are scored too, and their scores left out
        scores = staged(view_scores(outside, views).join(marked, "doc_id", "left_anti"), "views")
        out = []
        for view in ("content", "layout"):
            low, high = sure_limits(scores, view, sure_share, good)
            label = F.when(F.col(view) >= F.lit(float(high)), 1).when(F.col(view) < F.lit(float(low)), 0)
            sure = scores.groupBy("doc_id").agg(F.min(label).alias("label")).where("label is not null")
            out.append(described(outside, sample_rows(sure, F.col("doc_id"), pseudo_rows)))
        release(scores)
        return out[0], out[1]

    return co_train(known, exchange, rounds)


def co_train(known: Rows, exchange: Callable[[Views, float], tuple[Rows, Rows]], rounds: int = ROUNDS) -> Model:
    """Trains both views in turns: ``exchange`` gives what either view is sure of, which the
    other one is trained on in the next round, beside the rows with labels."""
    held = np.zeros(len(known.label), bool)
    held[4::5] = True
    first, checks = known.take(~held), known.take(held)
    mean, scale = known.layout.mean(0), np.maximum(known.layout.std(0), 1e-6)
    views = train_views(first, first, mean, scale)
    for _ in range(rounds):
        from_content, from_layout = exchange(views, first.label.mean())
        views = train_views(first + from_layout, first + from_content, mean, scale)
    rows = checks if len(set(checks.label.tolist())) == 2 else first
    z = np.stack([np.ones(len(rows.label)), views.content_of(rows), views.layout_of(rows)], 1)
    both = newton(z, rows.label.astype(float), 1e-3)
    return Model(views.table[:, 1:] - views.table[:, :1], views.layout, mean, scale, both)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` (text, source, lang) with ``quality_score`` from 0 to 1 appended; an input
    column of that name is replaced.

    Null and empty texts are scored as texts without subwords and of one empty line;
    null sources and languages are values of their own. Without a model every
    score is 0.5. One narrow pass over whole texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch):
                texts = [text or "" for text in block.column("text").to_pylist()]
                found = np.full(len(texts), 0.5)
                if model is not None:
                    places = zip(texts, block.column("source").to_pylist(), block.column("lang").to_pylist(), strict=True)
                    layout = np.array([layout_of(*place) for place in places])
                    found = model.scores(text_logits(texts, model.table)[:, 0], layout)
                yield put(block, {"quality_score": pa.array(found, pa.float64())})

    return docs.mapInArrow(run, schema_with(docs, quality_score="double"))

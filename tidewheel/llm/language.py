"""Language ID: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its subwords (runs of two, three and four
bytes of lower-case letters, hashed to buckets), and a softmax over a linear map of that
mean gives its language. Both are trained by stochastic gradient descent in
numpy. A temperature and a rejection threshold are calibrated on rows of the
sample that training did not see.

For scoring, embedding and linear map are multiplied out once, to one row of
logits per bucket; a text's logits are then a mean over looked-up rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import held_out, put, sample_rows, schema_with, text_blocks

TRAIN_ROWS = 4_000
"""Rows that the model is learned from, about; all of them if there are fewer."""
BUCKETS = 1 << 15
DIM = 16
EPOCHS = 4
BATCH = 32
RATE = 0.5
ACCEPT = 0.99
"""Share of right calibration predictions that the rejection threshold keeps."""

_LETTER = regex.compile(r"\p{L}")
# Bytes that are no letters in ASCII become blanks; bytes of longer sequences stay.
_CLEAN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    languages: list[str]
    logits: np.ndarray
    temperature: float
    threshold: float


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of the texts, and where each text's subwords begin.

    A text without any still has one, of its margins.
    """
    raw = [b" " + text.lower().encode("utf-8", "replace").translate(_CLEAN) + b"   " for text in texts]
    data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    starts = np.cumsum([0, *map(len, raw)])[:-1]
    pair = data[:-3] | data[1:-2] << np.uint64(8)
    three = pair | data[2:-1] << np.uint64(16)
    four = three | data[3:] << np.uint64(24)
    shift = np.uint64(64 - 15)
    grams = [
        ((gram + np.uint64(n << 40)) * _SPREAD >> shift).astype(np.int32)
        for n, gram in ((2, pair), (3, three), (4, four))
    ]
    # the last three places of a text only see its margin and the next text
    return np.concatenate([*grams]).reshape(3, -1), starts


def text_logits(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Mean logits per text."""
    buckets, starts = subwords(texts)
    sums = np.zeros((buckets.shape[1], table.shape[1]), np.float32)
    for row in buckets:
        sums += table[row]
    ends = np.append(starts[1:], buckets.shape[1] + 3)
    keep = np.ones(buckets.shape[1] + 3, bool)
    for back in (1, 2, 3):
        keep[ends - back] = False
    sums[~keep[: len(sums)]] = 0
    totals = np.add.reduceat(sums, np.minimum(starts, len(sums) - 1), axis=0).astype(np.float64)
    return totals / (3 * np.maximum(ends - starts - 3, 1))[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each sampled text as its distinct buckets and their shares."""
    for batch in batches:
        ids, shares = [], []
        for text in batch.column("text").to_pylist():
            # the same places as in scoring
            buckets, _ = subwords([text])
            found, counts = np.unique(buckets, return_counts=True)
            ids.append(found.astype(np.int32))
            shares.append((counts / counts.sum()).astype(np.float32))
        yield pa.RecordBatch.from_pydict(
            {
                "lang": batch.column("lang"),
                "ids": pa.array(ids, pa.list_(pa.int32())),
                "shares": pa.array(shares, pa.list_(pa.float32())),
            }
        )


def train(
    ids: list[np.ndarray], shares: list[np.ndarray], y: np.ndarray, classes: int, seed: int = 7, rate: float = RATE
):
    """Embedding and linear map after ``EPOCHS`` passes of mini-batch gradient descent."""
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    linear = np.zeros((DIM, classes), np.float32)
    for epoch in range(EPOCHS):
        step = rate * (1 - epoch / EPOCHS)
        order = rng.permutation(len(y))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            mean = np.stack([shares[r] @ embed[ids[r]] for r in rows])
            slope = softmax(mean @ linear)
            slope[np.arange(len(rows)), y[rows]] -= 1
            back = slope @ linear.T
            linear -= step * mean.T @ slope
            for r, g in zip(rows, back, strict=True):
                embed[ids[r]] -= (step * 20 * shares[r])[:, None] * g
    return embed, linear


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model | None:
    """Learns from text and language of rows outside the held-out fifth.

    ``train_rows`` bounds the sample, of which every fifth row calibrates. ``None``
    if no row has a language and a letter.
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = sample_rows(rows.select("doc_id", "text", "lang"), F.col("doc_id"), train_rows)
    table = rows.select("text", "lang").mapInArrow(
        _counted, "lang string, ids array<int>, shares array<float>"
    ).toArrow()
    if not table.num_rows:
        return None
    names = table.column("lang").to_pylist()
    languages = sorted(set(names))
    y = np.array([languages.index(name) for name in names])
    ids = [np.asarray(x.values) for x in table.column("ids")]
    shares = [np.asarray(x.values) for x in table.column("shares")]
    # order by content, so that the order in which tasks end does not matter
    order = sorted(range(len(y)), key=lambda i: (names[i], ids[i].tobytes(), shares[i].tobytes()))
    ids, shares, y = [ids[i] for i in order], [shares[i] for i in order], y[order]
    held = np.arange(len(y)) % 5 == 4
    used = np.flatnonzero(~held)
    embed, linear = train([ids[i] for i in used], [shares[i] for i in used], y[used], len(languages))
    logits = (embed @ linear).astype(np.float32)
    checks = np.flatnonzero(held) if held.any() else used
    z = np.stack([shares[i] @ logits[ids[i]] for i in checks])
    temperature, threshold = calibrate(z.astype(np.float64), y[checks])
    return Model(languages, logits, temperature, threshold)


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The temperature of least log loss, and the score that all but the lowest
    hundredth of right predictions reach."""
    loss = {
        t: -np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in 2.0 ** np.arange(-6, 4)
    }
    temperature = min(loss, key=loss.get)
    p = softmax(z / temperature)
    right = p.max(1)[p.argmax(1) == y]
    return float(temperature), float(np.quantile(right, 1 - ACCEPT)) if len(right) else 1.0


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_rejected`` appended; input
    columns of these names are replaced.

    Null texts and texts without a letter are ``und`` with score 0 and rejected, and
    so is everything without a model. Other texts get the likeliest language;
    ``lang_rejected`` tells that its calibrated score stays below the threshold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, text_col):
                texts = [text or "" for text in block.column(text_col).to_pylist()]
                known = np.array([bool(model and _LETTER.search(text)) for text in texts], bool)
                names = np.full(len(texts), "und", object)
                score = np.zeros(len(texts))
                if known.any():
                    some = [text for text, ok in zip(texts, known, strict=True) if ok]
                    p = softmax(text_logits(some, model.logits) / model.temperature)
                    names[known] = [model.languages[i] for i in p.argmax(1)]
                    score[known] = p.max(1)
                rejected = ~known | (score < (model.threshold if model else 1.0))
                yield put(
                    block,
                    {
                        "lang_pred": pa.array(names, pa.string()),
                        "lang_score": pa.array(score, pa.float64()),
                        "lang_rejected": pa.array(rejected, pa.bool_()),
                    },
                )

    return docs.mapInArrow(run, schema_with(docs, lang_pred="string", lang_score="double", lang_rejected="boolean"))

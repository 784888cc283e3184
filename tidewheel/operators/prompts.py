"""Batch scoring of prompt tables through a function the caller supplies."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.arrays import cap_words
from tidewheel.operators.ordering import Layout, ordinal
from tidewheel.sources.versions import VersionedTable

# The system text and the answer length of every request.
SYSTEM_TEXT = "You are an AI assistant"
MAX_TOKENS = 256

Complete = Callable[[Sequence[str]], Sequence[str]]


def chat_messages(prompt: Column, system: str = SYSTEM_TEXT) -> Column:
    """A fixed system message followed by the user's prompt."""
    return F.array(_message("system", F.lit(system)), _message("user", prompt))


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def chat_request(
    prompt: Column, model: str, system: str = SYSTEM_TEXT, max_tokens: int = MAX_TOKENS
) -> Column:
    """The request body as JSON text."""
    return F.to_json(
        F.struct(
            chat_messages(prompt, system).alias("messages"),
            F.lit(model).alias("model"),
            F.lit(max_tokens).alias("max_tokens"),
        )
    )


def offline_complete(requests: Sequence[str]) -> list[str]:
    """A completion function that needs no service: it repeats the prompt, capped in words."""
    responses = []
    for request in requests:
        body = json.loads(request)
        words = f"You said: {body['messages'][-1]['content']}".split(" ")
        content = " ".join(words[: body["max_tokens"]])
        message = {"role": "assistant", "content": content}
        responses.append(json.dumps({"choices": [{"index": 0, "message": message}]}))
    return responses


def batch_complete(
    df: DataFrame,
    request: str = "request",
    complete: Complete = offline_complete,
    parallelism: int | None = None,
) -> DataFrame:
    """Add ``response`` and ``error``; a row that fails gets no response but keeps its place.

    ``complete`` is called with a batch of request bodies. If the batch fails it
    is tried row by row, so one bad prompt does not cost its neighbours.
    ``parallelism`` bounds the number of batches under way at a service. A filter on the
    result never makes a row be asked twice.
    """

    def attempt(requests: Sequence[str]) -> list[dict]:
        try:
            responses = list(complete(requests))
            if len(responses) != len(requests):
                raise ValueError(f"{len(responses)} responses for {len(requests)} requests")
            return [{"response": response, "error": None} for response in responses]
        except Exception as problem:  # noqa: BLE001 - any failure belongs to its row
            if len(requests) == 1:
                return [{"response": None, "error": f"{type(problem).__name__}: {problem}"}]
            return [row for one in requests for row in attempt([one])]

    @F.arrow_udf("response string, error string")
    def score(requests: pa.Array) -> pa.Array:
        fields = pa.struct([("response", pa.string()), ("error", pa.string())])
        return pa.array(attempt(requests.to_pylist()) if len(requests) else [], fields)

    spread = df.repartition(parallelism) if parallelism else df
    # an answer may differ from call to call: no filter is pushed below it, no copy made of it
    asked = spread.withColumn("__scored", score.asNondeterministic()(request))
    return asked.select(*df.columns, "__scored.*")


def answered(
    df: DataFrame,
    answers: VersionedTable,
    request: str = "request",
    complete: Complete = offline_complete,
    parallelism: int | None = None,
) -> DataFrame:
    """``df`` with ``response`` and ``error``, from ``answers`` that are kept by request.

    Only requests that have no response yet are asked, each of them once however many rows
    have it, and what comes back is committed before it is used. So a job that is run again
    asks for what is missing, failed requests among it. A null request is not asked.
    """
    keyed = df.withColumn("__key", F.sha2(F.col(request).cast("binary"), 256))
    wanted = keyed.where(F.col(request).isNotNull()).groupBy("__key").agg(F.any_value(request).alias("__request"))
    missing = wanted
    if answers.versions():
        known = answers.read().where("response IS NOT NULL").select(F.col("key").alias("__key"))
        missing = wanted.join(known, "__key", "left_anti")
    scored = batch_complete(missing, "__request", complete, parallelism)
    attempt = F.lit(len(answers.versions())).alias("attempt")
    answers.write(scored.select(F.col("__key").alias("key"), "response", "error", attempt))
    # a response if there is one, else the last error
    last = F.max_by(F.struct("response", "error"), F.struct(F.col("response").isNotNull(), "attempt"))
    found = answers.read().groupBy(F.col("key").alias("__key")).agg(last.alias("__found"))
    return keyed.join(found, "__key", "left").select(*df.columns, "__found.response", "__found.error")


def response_text(response: Column) -> Column:
    return F.get_json_object(response, "$.choices[0].message.content")


def token_cap(text: Column, limit: int = MAX_TOKENS) -> Column:
    """At most ``limit`` blank-separated words."""
    return cap_words(text, limit)


def numbered_prompts(
    df: DataFrame, order: Sequence[str], out: str = "ordinal", layout: Layout = Layout()
) -> DataFrame:
    """Prompts sorted by ``order`` with their place in it, counted from 1.

    Number the prompts before they are scored: a sort after scoring samples its
    input first, and would put every prompt to the service twice.
    """
    return ordinal(df, [], order, out, layout).orderBy(out)


def prompt_report(
    df: DataFrame, number: str = "ordinal", prompt: str = "prompt", response: str = "response"
) -> DataFrame:
    """A prompt and a response line per row of a numbered, scored table."""
    return df.select(
        number,
        F.format_string("Prompt %d: %s", number, prompt).alias("prompt_line"),
        F.format_string("Response %d: %s", number, response).alias("response_line"),
    )

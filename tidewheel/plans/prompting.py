"""Queries on prompt tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.operators import prompts
from tidewheel.plans.data import load
from tidewheel.plans.registry import query
from tidewheel.session import shared_dir
from tidewheel.sources.versions import VersionedTable

MODEL = "offline"

_REQUEST_SQL = f"""to_json({{'messages': [{{'role': 'system', 'content': '{prompts.SYSTEM_TEXT}'}},
      {{'role': 'user', 'content': text}}], 'model': '{MODEL}',
      'max_tokens': {prompts.MAX_TOKENS}}})::VARCHAR"""

_ANSWER_SQL = f"array_to_string(string_split('You said: '||text, ' ')[1:{prompts.MAX_TOKENS}], ' ')"


def user_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = load(spark, folder, "conversations").where("role = 'user'")
    return turns.select("conv_id", "turn", F.col("text").alias("prompt"))


def requests(turns: DataFrame) -> DataFrame:
    return turns.withColumn("request", prompts.chat_request(F.col("prompt"), MODEL))


def answers(turns: DataFrame) -> DataFrame:
    scored = prompts.batch_complete(requests(turns))
    return scored.withColumn("response", prompts.response_text(F.col("response")))


@query(f"SELECT conv_id, turn, {_REQUEST_SQL} AS request FROM conversations WHERE role = 'user'")
def chat_request(spark: SparkSession, folder: str) -> DataFrame:
    return requests(user_turns(spark, folder)).drop("prompt")


@query(
    f"""SELECT conv_id, turn, {_ANSWER_SQL} AS response, NULL::VARCHAR AS error
    FROM conversations WHERE role = 'user'"""
)
def batch_complete(spark: SparkSession, folder: str) -> DataFrame:
    """Every prompt scored, as many batches at a time as there are cores."""
    turns = requests(user_turns(spark, folder))
    scored = prompts.batch_complete(turns, parallelism=spark.sparkContext.defaultParallelism)
    return scored.select("conv_id", "turn", prompts.response_text(F.col("response")).alias("response"), "error")


@query(
    f"""SELECT conv_id, turn, {_ANSWER_SQL} AS response, NULL::VARCHAR AS error
    FROM conversations WHERE role = 'user'"""
)
def complete_once(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the conversations scored, then all of them: each prompt is asked once."""
    turns = requests(user_turns(spark, folder))
    store = VersionedTable(spark, shared_dir(spark, "answers"))
    prompts.answered(turns.where("conv_id % 2 = 0"), store)
    scored = prompts.answered(turns, store, parallelism=spark.sparkContext.defaultParallelism)
    return scored.select("conv_id", "turn", prompts.response_text(F.col("response")).alias("response"), "error")


@query("SELECT conv_id, turn, text AS content FROM conversations")
def response_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn as a service would return it, and its text taken out again."""
    message = F.struct(F.col("role"), F.col("text").alias("content"))
    choice = F.struct(F.lit(0).alias("index"), message.alias("message"))
    body = F.to_json(F.struct(F.array(choice).alias("choices")))
    turns = load(spark, folder, "conversations").select("conv_id", "turn", body.alias("body"))
    return turns.select("conv_id", "turn", prompts.response_text(F.col("body")).alias("content"))


@query(
    f"""SELECT doc_id, array_to_string(w[1:{prompts.MAX_TOKENS}], ' ') AS text, len(w)::INT AS n_words
    FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)"""
)
def token_cap(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "documents").select(
        "doc_id",
        prompts.token_cap(F.col("text")).alias("text"),
        F.size(F.split("text", " ")).alias("n_words"),
    )


@query(
    f"""SELECT ordinal, 'Prompt '||ordinal||': '||text AS prompt_line,
      'Response '||ordinal||': '||{_ANSWER_SQL} AS response_line
    FROM (SELECT text, row_number() OVER (ORDER BY conv_id, turn) AS ordinal
      FROM conversations WHERE role = 'user') ORDER BY ordinal"""
)
def prompt_report(spark: SparkSession, folder: str) -> DataFrame:
    numbered = prompts.numbered_prompts(user_turns(spark, folder), ["conv_id", "turn"])
    return prompts.prompt_report(answers(numbered))

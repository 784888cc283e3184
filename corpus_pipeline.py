"""The corpus pipeline: five stages from raw documents to encoded training text.

Each stage works on all that the one before kept and returns the columns of
``documents``; the last one adds the encoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import mixing, near_dedup, secrets, tokens, toxicity
from tidewheel.llm.common import free_name, release, staged, table, workspace
from tidewheel.llm.queries import vocabulary
from tidewheel.session import ship

#: Of stages 2 to 5 no SQL speaks: the first learns a model, the last merges tokens.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half."""
    ship(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    mark = free_name(docs, "toxic_score")
    return toxicity.score(docs, model, score_col=mark).where(F.col(mark) < 0.5).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies (five words, 0.8).

    Rows that repeat an id with equal text count as copies: one of them stays. Rows
    without an id stay, as no id can name the one to keep.
    """
    ship(spark)
    found = near_dedup.near_duplicates(docs, size=5, percent=80)
    first = docs.join(found.where("kept").select("doc_id"), "doc_id", "left_semi")
    nameless = docs.where("doc_id is null")
    return first.dropDuplicates(["doc_id", "text"]).select(docs.columns).union(nameless)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of every secret found."""
    ship(spark)
    spans = free_name(docs, "_spans")
    found, rest = secrets.scan(docs, spans_col=spans)
    clean = secrets.redact(F.col("text"), F.col(spans))
    changed = found.withColumn("text", F.when(F.size(spans) > 0, clean).otherwise(F.col("text")))
    changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(docs.columns).union(rest.select(docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: whole texts, once per epoch, and once
    more if at least half of their words are taken in the epoch that is cut.

    Rows are numbered and written first, so each row has a count of its own, whether
    its id is null or repeats. Texts without words are never taken.
    """
    ship(spark)
    numbered = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "rows")
    taken = mixing.mix(numbered.select("row.*", F.col("number").alias(free_name(docs, "_number"))), row_col=free_name(docs, "_number"))
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    copies = taken.where("size > 0").select(F.col("row").alias("number"), times.alias("times")).where("times > 0")
    rows = numbered.join(copies, "number")
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, and digests of these and of the decoded text.

    Input columns named like one of these outputs are replaced.
    """
    ship(spark)
    outputs = ("n_tokens", "token_ids", "decoded_sha256")
    kept = [name for name in docs.columns if name.lower() not in outputs]
    # all columns but the text in a struct, so that no name of theirs meets one of an output
    rows = docs.select(F.struct(*(name for name in kept if name != "text")).alias("row"), "text")
    encoded = tokens.encode(rows, vocabulary())
    return encoded.select(
        *(F.col("text" if name == "text" else f"row.{name}") for name in kept),
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        "token_ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", encode_text),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again. What a stage has
    written for itself is removed when its result is there, and so is the result before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = None
    for name, stage in STAGES[:-1]:
        with workspace() as keep:
            docs = keep(staged(stage(spark, docs, sf_dir), name))
        if last is not None:
            release(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)

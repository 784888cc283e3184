"""The queries of this folder's operators, and SQL that checks those it can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import (
    alignment,
    cleaning,
    embedding_dedup,
    language,
    mixing,
    near_dedup,
    quality,
    runs,
    secrets,
    substrings,
    tokens,
    topk,
    toxicity,
)
from tidewheel.llm.common import documents, held_out, table
from tidewheel.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(spark, sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return run

    return register


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text", "source", "lang"), model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, rest = secrets.scan(documents(spark, sf_dir))
    none = F.array().cast(dict(found.dtypes)["_spans"])
    spans = F.col("_spans")
    rows = found.select("doc_id", "_spans").unionByName(rest.select("doc_id", none.alias("_spans")))
    count = lambda rank: F.size(F.filter(spans, lambda x: x["rank"] == rank)).cast("long")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.label(secrets.base_only(spans)), 256).alias("base_sha256"),
        secrets.label(spans).alias("spans"),
        F.size(F.filter(spans, lambda x: x["live"])).cast("long").alias("n_live"),
    )


@query()
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(documents(spark, sf_dir))
    runs = F.transform("spans", lambda x: x["stop"] - x["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(runs, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=3, percent=85)


@query(
    r"""
    WITH d AS (
      SELECT doc_id, source,
             coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
             CASE WHEN length(text) > 0 THEN 0.25::DOUBLE + 0.75::DOUBLE
               * (length(text) - length(regexp_replace(text, '\p{L}+', '', 'g')))
               / length(text)::DOUBLE ELSE 0.25::DOUBLE END AS w,
             (('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE)
               / 4503599627370496::DOUBLE AS u
      FROM documents),
    k AS (SELECT *, -ln(u) / w AS key FROM d),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
    w AS (SELECT *, 2 * source_size AS cap,
                 CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                   WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
    l AS (SELECT *, cap / weight AS ratio,
                 (1.5::DOUBLE * sum(source_size) OVER ()
                   - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
    t AS (SELECT source, source_size,
                 least(cap::DOUBLE, weight * (SELECT max(level) FROM l WHERE level <= ratio)) AS target
          FROM l),
    p AS (SELECT k.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
                 coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
    SELECT doc_id, size, source_size, target,
           (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
    FROM e
    """
)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source")


@query()
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = tokens.encode(documents(spark, sf_dir).select("doc_id", "text"), vocabulary())
    return encoded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
    r AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """
)
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query(
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS MATERIALIZED (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
    reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
    c AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
    n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
    SELECT c.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, c.vec_id = component_id AS kept
    FROM c LEFT JOIN n USING (vec_id)
    """
)
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def repeat_tail(words: list[bytes], row: dict) -> list[bytes]:
    """Of one row in ten, by its id, the words from a place on repeat a few of them;
    rows without an id stay as they are."""
    if row["doc_id"] is None or not words:
        return words
    mark = zlib.crc32(str(row["doc_id"]).encode())
    if mark % 10:
        return words
    group, n = mark // 10, len(words)
    at = group % n
    period = 1 + (n - at) // (3 + group % 8)
    return words[:at] + [words[at + i % period] for i in range(n - at)]


@query()
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(documents(spark, sf_dir).select("doc_id", "text"), change=repeat_tail)
    key = F.transform("runs", lambda x: F.struct(x["length"].alias("n"), (-x["start"]).alias("a"), (-x["period"]).alias("b")))
    longest = found.withColumn("longest", F.array_max(key))
    length, period = F.col("longest.n"), -F.col("longest.b")
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.a")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


@query(
    r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS text,
             coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words
      FROM documents),
    l AS (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos
      FROM d),
    c AS (
      SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
             row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS seen,
             len(regexp_extract_all(line, '[|›»•·]')) AS separators,
             length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
             length(regexp_replace(line, '[^A-Z]', '', 'g')) AS capitals,
             length(regexp_replace(line, '[^a-z]', '', 'g')) AS small
      FROM l),
    f AS (
      SELECT doc_id, words, seen, CASE
        WHEN separators >= 2 AND 4 * separators >= words THEN 'navigation'
        WHEN 2 * symbols > words OR (capitals >= 20 AND capitals > small) OR (words <= 20 AND (seen
          OR regexp_matches(lower(line), 'cookie|javascript|privacy policy|terms of use|terms of service|all rights reserved|lorem ipsum|sign in|log in|subscribe|click here|read more|share this|skip to content')))
          THEN 'boilerplate'
        WHEN NOT regexp_matches(line, '[.!?:;…]["''”’»)\]}*_]*[\x20\x09-\x0D]*$')
          AND NOT regexp_matches(line, '[.!?…][\x20\x09-\x0D]') THEN 'punctuation'
        ELSE 'none' END AS fault
      FROM c WHERE words > 0),
    s AS (
      SELECT doc_id, count(*) FILTER (seen) AS n_dup_lines,
             coalesce(sum(words) FILTER (fault = 'none'), 0)::BIGINT AS n_kept_words
      FROM f GROUP BY doc_id),
    w AS (
      SELECT doc_id, unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS five,
             unnest(range(1, len(words) - 3)) AS i
      FROM d WHERE len(words) > 4),
    t AS (SELECT *, count(*) OVER (PARTITION BY doc_id, five) AS times FROM w),
    r AS (
      SELECT doc_id, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM t WHERE times > 1) GROUP BY doc_id),
    a AS (
      SELECT doc_id, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_kept_words, 0)::BIGINT AS n_kept_words
      FROM d LEFT JOIN s USING (doc_id) LEFT JOIN r USING (doc_id)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
    SELECT *, NOT base_failed AND 100 * n_kept_words >= 70 * n_words AS kept FROM b
    """
)
def op12_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean_documents(documents(spark, sf_dir).select("doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_kept_words"]
    return cleaned.select("doc_id", *counts, "base_failed", "kept")


@query()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = alignment.align(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return found.drop("groups")

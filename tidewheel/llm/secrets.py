"""Secret scans with corpus-wide ownership of every candidate value.

Patterns find candidates. Every candidate value is hashed, and the corpus is asked
in how many repositories (documents) and with how many owners (sources) the same
value appears. A value with many owners is an example that people copy; one with
a single owner or two, and random to look at, is a credential that may be live.
All of it is made of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import free_name, staged

# What each kind looks like.
ASSIGN = (
    r"(?=[PpSsTtAa])(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
_TOKEN = r"[A-Za-z0-9+/_=-]"
OPAQUE = rf"(?<!{_TOKEN})(?={_TOKEN}*[0-9])(?={_TOKEN}*[A-Za-z]){_TOKEN}{{32,}}"
# Cheap signs that a text may hold a match: a delimiter, or any token of 20 characters.
DELIMITERS = (":", "=")
LONG_TOKEN = rf"(?<!{_TOKEN}){_TOKEN}{{20,}}+"

KINDS = ("assign", "access", "hex", "opaque")
BASE_KINDS = 3
MIN_VALUE = 6
MAX_OWNERS = 2
SPAN = "array<struct<start:long,rank:int,stop:long,hash:string>>"


def _spans(text: Column, pattern: str, rank: int, group: int = 0) -> Column:
    """Matches with their code points: pieces between matches and matches in turn.

    Texts without a match skip the work; ``AKIA[A-Z0-9]+`` and ``[0-9a-f]+`` with a
    least length match the same runs as the patterns that set it, since a run of
    characters of one class is matched whole or not at all.
    """
    found = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
        F.slice(F.split(text, pattern, -1), F.lit(1), F.greatest(F.lit(0), F.size(F.split(text, pattern, -1)) - 1)).alias("gap"),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("out"))

    def add(state: Column, item: Column) -> Column:
        begin = (state["at"] + F.length(item["gap"])).cast("long")
        end = (begin + F.length(item["whole"])).cast("long")
        span = F.struct(
            begin.alias("start"),
            F.lit(rank).alias("rank"),
            end.alias("stop"),
            F.sha2(item["value"], 256).alias("hash"),
        )
        kept = F.length(item["value"]) >= MIN_VALUE
        out = F.when(kept, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    spans = F.aggregate(found, start, add, lambda state: state["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def _base(text: Column) -> Column:
    return F.concat(_spans(text, ASSIGN, 0, 2), _spans(text, ACCESS, 1), _spans(text, HEX, 2))


def _candidate(text: Column) -> Column:
    delimited = text.contains(DELIMITERS[0]) | text.contains(DELIMITERS[1])
    runs = text.rlike(ACCESS) | text.rlike(HEX) | text.rlike(OPAQUE)
    return (delimited & text.rlike(ASSIGN)) | (text.rlike(LONG_TOKEN) & runs)


def scan(
    docs: DataFrame, text_col: str = "text", owner_col: str = "source", spans_col: str = "_spans"
) -> tuple[DataFrame, DataFrame]:
    """Rows that hold candidates, and the rest; both with all columns of ``docs``.

    The first gains ``spans_col``, which replaces an input column of that name, sorted
    by start and kind: (start, rank, stop, hash,
    n_repositories, n_owners, live), positions in code points, the end exclusive.
    ``rank`` counts in ``KINDS``. Base kinds keep all their spans whatever the counts
    say. The last kind, long tokens of mixed characters outside the base spans, is
    what the counts add: only values of at most ``MAX_OWNERS`` owners become spans.

    Null and empty texts hold nothing. A null owner counts as one owner. A row that
    repeats another counts as a repository of its own. Only rows with candidates are
    written to the shared folder and matched with counts; a value found everywhere
    is first counted per owner, in partial sums.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rest = docs.where(~_candidate(text))
    outside = lambda spans: lambda x: ~F.exists(
        spans, lambda y: (x["start"] < y["stop"]) & (y["start"] < x["stop"])
    )
    # a name of a column of the input is never taken for a column that is only passed on
    row, base, more = (free_name(docs, name) for name in ("_row", "_base", "_more"))
    hits = docs.where(_candidate(text)).withColumn(base, _base(text))
    hits = hits.withColumn(more, F.filter(_spans(text, OPAQUE, 3), outside(F.col(base))))
    hits = hits.withColumn(row, F.monotonically_increasing_id())
    hits = staged(hits, "secrets")
    each = hits.select(
        F.col(row).alias("_row"),
        F.col(owner_col).alias("_owner"),
        F.explode(F.concat(base, more)).alias("_span"),
    )
    by_owner = (
        each.select("_row", "_owner", F.col("_span.hash").alias("hash"))
        .distinct()
        .groupBy("hash", "_owner")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    owned = by_owner.groupBy("hash").agg(
        F.sum("n").alias("n_repositories"), F.count(F.lit(1)).alias("n_owners")
    )
    judged = (
        each.select("_row", "_span.*")
        .join(owned, "hash")
        .withColumn("live", F.col("n_owners") <= MAX_OWNERS)
        .where((F.col("rank") < BASE_KINDS) | F.col("live"))
        .groupBy("_row")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("start", "rank", "stop", "hash", "n_repositories", "n_owners", "live"))
            ).alias("_spans")
        )
    )
    found = F.coalesce("judged._spans", F.array().cast(dict(judged.dtypes)["_spans"]))
    joined = hits.alias("hits").join(judged.alias("judged"), F.col(f"hits.{row}") == F.col("judged._row"), "left")
    columns = [F.col(f"hits.{name}") for name in docs.columns if name.lower() != spans_col.lower()]
    return joined.select(*columns, found.alias(spans_col)), rest


def label(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"].cast("string"), x["stop"].cast("string")),
        ),
        ",",
    )


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["rank"] < BASE_KINDS)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced: ``[secret]`` if live, else ``[example]``.

    Spans that overlap become one mark, named by the first of them.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def cut(state: Column, span: Column) -> Column:
        inside = span["start"] < state["at"]
        gap = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(F.lit(0), span["start"] - state["at"]).cast("int"))
        mark = F.when(span["live"], F.lit("[secret]")).otherwise(F.lit("[example]"))
        return F.struct(
            F.when(inside, state["out"]).otherwise(F.concat(state["out"], gap, mark)).alias("out"),
            F.greatest(state["at"], span["stop"]).alias("at"),
        )

    def close(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    return F.aggregate(spans, start, cut, close)

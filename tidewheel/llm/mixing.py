"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key, ``-ln(u) / quality``, with ``u`` a hash of
its id. In the order of these keys a source's documents form an
Efraimidis-Spirakis sample of any length. A source whose target is above its own
size is first taken whole, once for every complete epoch; the rest of the target
is then filled from the front of that order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
ROWS_PER_RANGE = 20_000
"""Rows of a source that one task may sort; more are cut into ranges of the key."""
WORDS = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """From 0.25 to 1: a quarter, and three quarters of the share of letters."""
    length = F.length(text)
    letters = length - F.length(F.regexp_replace(text, r"\p{L}+", ""))
    return F.when(length > 0, 0.25 + 0.75 * letters / length).otherwise(F.lit(0.25))


def exponential_key(doc_id: Column, weight: Column) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(uniform) / weight


def targets(sizes: DataFrame) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size), one row for each source.

    Sources in the order of their code points, null last, weigh 5, 2, 1 in turn.
    A target is ``weight * level``, but never above ``MAX_EPOCHS`` times the source.
    The level solves "all targets sum up to ``SHARE`` of all words": with sources
    sorted by the level at which they reach their cap, it is the first one that
    the next source does not reach (and the largest such, as later ones fall). The window
    spans one row per source: sources are datasets or sites that someone gives a
    weight to, and a million of them still sort in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*map(F.lit, WEIGHTS))[(F.row_number().over(by_name) - 1) % len(WEIGHTS)]
    ranked = sizes.withColumn("weight", weight).withColumn("cap", MAX_EPOCHS * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    ranked = ranked.withColumn("level", level).withColumn(
        "level", F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(everything)
    )
    return ranked.select(
        "source",
        "source_size",
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row for each input row.

    ``row_col`` is a column of ``docs`` that tells rows apart, to be passed on as ``row``:
    ids may be null and may repeat.

    ``taken`` counts the words that the mix takes of a document: all of it for each
    complete epoch, and all, some or none of it in the epoch that is not complete.
    So the words taken of a source sum up to its target, rounded. Null and empty
    texts have size 0 and are never taken; null sources form one source. Rows that
    repeat an id share its key and are taken one after the other.

    Positions in a source come in two steps, so that no task sorts a whole source:
    words per range of the key, summed up over ranges, and a window within each
    range. The ranges grow in number with the rows.
    """
    narrow = staged(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            words(F.col(text_col)).alias("size"),
            exponential_key(F.col(id_col), quality(F.col(text_col))).alias("key"),
            *([F.col(row_col).alias("row")] if row_col else []),
        ),
        "mix",
    )
    tagged = narrow.withColumn("tag", F.concat(F.lit("s"), F.col("source"))).fillna("-", ["tag"])
    ranges = max(64, -(-narrow.count() // ROWS_PER_RANGE))
    tagged = tagged.withColumn(
        "range", F.least(F.lit(ranges - 1), F.floor(ranges * (1 - F.exp(-0.8 * F.col("key"))))).cast("long")
    )
    summed = tagged.groupBy("tag", "source", "range").agg(F.sum("size").alias("words"))
    aims = targets(summed.groupBy("source").agg(F.sum("words").alias("source_size")))
    aims = aims.withColumn("tag", F.concat(F.lit("s"), F.col("source"))).fillna("-", ["tag"]).drop("source")
    earlier = Window.partitionBy("tag").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        summed.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .join(aims, "tag")
        .select("tag", "range", "before", "source_size", "target")
    )
    within = (
        Window.partitionBy("tag", "range")
        .orderBy("key", "doc_id", "size", *(["row"] if row_col else []))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - F.col("epochs") * F.col("source_size")
    before = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    placed = (
        tagged.join(plan, ["tag", "range"])
        .withColumn("before", before)
        .withColumn("epochs", whole.cast("long"))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        *(["row"] if row_col else []),
    )

"""MinHash near-dedup: universal hash minima, bands, verification, star components.

1. Every document becomes the set of its distinct word shingles (as 64-bit hashes).
   Documents with equal sets are one node.
2. A node's signature holds the minima of many universal hash functions; nodes that
   agree on a band of minima share a bucket. Each member of a bucket is tied to its
   smallest one, and the components of these ties are families: any two documents
   that share a bucket are in one family.
3. Within a family, links are confirmed on the full sets. Families are cut into
   blocks of bounded size, and only blocks whose set sizes allow the similarity
   are compared; signatures rule out most pairs before the sets are.
4. Components of the confirmed links come from alternating large-star and small-star.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import packed_texts, staged, text_blocks, unpack
from tidewheel.llm.graph import components, stars

BANDS, ROWS = 40, 8
"""At a similarity of 0.85 two documents miss all bands once in 300,000 pairs."""
SKETCH = 128
"""Minima of a signature, a byte of each, that verify a pair before its sets are compared."""
DEVIATIONS = 6
BLOCK = 256
SHINGLES = 2_000_000
"""Members of a block, and shingles of all of them: a task holds two blocks."""
CELLS = 4_000_000
SEED = 20240229

_SPACE = bytes(32 if b in (32, *range(9, 14)) else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word: lower-case A-Z, words between ASCII white space.

    A word's hash is the sum over its bytes of a mix of byte and position in the word,
    mixed once more with its length; all words of a text are summed up at once.
    """
    raw = text.encode("utf-8", "replace").translate(_SPACE)
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = np.concatenate([[False], data != 32, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    # every byte's position in its word
    place = np.arange(len(data))
    place[start[0] :] -= np.repeat(start, np.diff(np.append(start, len(data))))
    values = mixed((data.astype(np.uint64) + np.uint64(1)) * _ODD + place.astype(np.uint64) * _MIX)
    total = np.concatenate([[np.uint64(0)], np.cumsum(values, dtype=np.uint64)])
    return mixed((total[stop] - total[start]) ^ ((stop - start).astype(np.uint64) * _ODD))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Distinct hashes of runs of ``size`` words, sorted; of all words if there are fewer."""
    words = word_hashes(text or "")
    if not len(words):
        return words
    width = min(size, len(words))
    runs = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        runs = mixed((runs + words[i : len(words) - width + 1 + i]) * _ODD)
    if width < size:
        runs = mixed(runs + np.uint64(width))
    return np.unique(runs)


class MinHash:
    """``bands * rows`` hash functions a x + b (a odd, modulo 2**32), and bands of their minima."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS) -> None:
        rng = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.a = (rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)[:, None]

    def signature(self, items: np.ndarray) -> np.ndarray:
        """Minima over the upper halves of the items."""
        out = np.full(len(self.a), np.iinfo(np.uint32).max, np.uint32)
        upper = (items >> np.uint64(32)).astype(np.uint32)
        space = np.empty((len(self.a), 256), np.uint32)
        for begin in range(0, len(upper), 256):
            some = upper[begin : begin + 256]
            hashed = np.multiply(self.a, some, out=space[:, : len(some)])
            hashed += self.b
            np.minimum(out, hashed.min(1), out=out)
        return out

    def band_hashes(self, signature: np.ndarray) -> np.ndarray:
        parts = signature.astype(np.uint64).reshape(self.bands, self.rows)
        out = np.arange(self.bands, dtype=np.uint64)
        for i in range(self.rows):
            out = mixed((out + parts[:, i]) * _ODD)
        return out.view(np.int64)


    def sketch(self, signature: np.ndarray) -> bytes:
        return signature[:: len(signature) // SKETCH][:SKETCH].astype(np.uint8).tobytes()


def plausible(sketches: np.ndarray, similarity: float) -> np.ndarray:
    """Pairs of rows whose sketches do not rule the similarity out by ``DEVIATIONS``
    standard deviations."""
    size = sketches.shape[1]
    equal = np.stack([(sketches == row).sum(1, dtype=np.int32) for row in sketches])
    least = similarity - DEVIATIONS * np.sqrt(similarity * (1 - similarity) / size)
    return equal >= least * size


def described(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, key, bands, sketch) for (doc_id, text); key is null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = MinHash()
        for batch in batches:
            for block in text_blocks(batch):
                counts, keys, bands, sketches = [], [], [], []
                for text in block.column("text").to_pylist():
                    items = shingles(text, size)
                    counts.append(len(items))
                    keys.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None)
                    signature = family.signature(items) if len(items) else None
                    bands.append(None if signature is None else family.band_hashes(signature))
                    sketches.append(None if signature is None else family.sketch(signature))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": block.column("doc_id"),
                        "n_shingles": pa.array(counts, pa.int64()),
                        "key": pa.array(keys, pa.binary()),
                        "bands": pa.array(bands, pa.list_(pa.int64())),
                        "sketch": pa.array(sketches, pa.binary()),
                    }
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key binary, bands array<long>, sketch binary")


def bucket_ties(nodes: DataFrame) -> DataFrame:
    """Edges (u, v) from each member of a bucket to the smallest; buckets of one drop out."""
    member = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = (
        member.groupBy("band", "bucket")
        .agg(F.min("node").alias("v"), F.max("node").alias("other"))
        .where("v <> other")
        .drop("other")
    )
    return member.join(shared, ["band", "bucket"]).where("node <> v").select(F.col("node").alias("u"), "v").distinct()


def tasks(members: DataFrame, similarity: float) -> DataFrame:
    """(node, task keys) so that any two members of a family that can be similar meet.

    Members of a family are cut by the logarithm of their set size into classes, of
    which only equal and adjacent ones can be similar, and each class into blocks of
    about ``BLOCK`` members, or ``SHINGLES`` shingles if that is less, by a hash. A member
    goes to the pair of its own block with every block of its class and of the two classes
    beside it. A family that fits into a block is one class of one block.
    """
    step = float(-np.log(similarity))
    whole = members.groupBy("family").agg(F.count(F.lit(1)).alias("m"), F.sum("n_shingles").alias("total"))
    sized = members.join(whole, "family")
    small = (F.col("m") <= BLOCK) & (F.col("total") <= SHINGLES)
    kind = F.when(small, F.lit(0)).otherwise(F.floor(F.log(F.col("n_shingles")) / step).cast("int"))
    sized = sized.withColumn("kind", kind)
    needed = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / SHINGLES)
    blocks = sized.groupBy("family", "kind").agg(F.ceil(needed).cast("int").alias("blocks"))
    around = blocks.select(
        "family",
        F.explode(F.array(F.col("kind") - 1, F.col("kind"), F.col("kind") + 1)).alias("kind"),
        F.struct((F.col("kind")).alias("kind"), "blocks").alias("beside"),
    )
    beside = around.groupBy("family", "kind").agg(F.collect_set("beside").alias("beside"))  # three at most
    placed = sized.join(blocks, ["family", "kind"]).join(beside, ["family", "kind"])
    own = F.struct(F.col("kind").alias("kind"), F.pmod(F.xxhash64("node", F.lit("block")), "blocks").cast("int").alias("block"))
    others = F.flatten(
        F.transform(
            "beside",
            lambda x: F.transform(
                F.sequence(F.lit(0), x["blocks"] - 1), lambda i: F.struct(x["kind"].alias("kind"), i.alias("block"))
            ),
        )
    )
    return placed.withColumn("own", own).select(
        "node", "sketch", "family", "own", F.explode(F.transform(others, lambda x: F.struct(F.least("own", x).alias("a"), F.greatest("own", x).alias("b")))).alias("pair")
    )


def confirm(
    ids: np.ndarray, sets: list[np.ndarray], sketches: np.ndarray, left: np.ndarray, percent: int
) -> np.ndarray:
    """Star edges that span the confirmed links between rows of ``left`` and the others
    (or among all rows if all are left). Rows whose sketches agree with no partner
    leave; for the rest it is exact: intersections are counted on the full sets, by
    matrix products over shared shingles, as many at a time as fit.
    """
    pairs = plausible(sketches, percent / 100)
    np.fill_diagonal(pairs, False)
    if not left.all():
        pairs &= left[:, None] != left[None, :]
    rows = np.flatnonzero(pairs.any(1))
    if not len(rows):
        return np.zeros((0, 2), np.int64)
    ids, sets, left = ids[rows], [sets[i] for i in rows], left[rows]
    pairs = pairs[np.ix_(rows, rows)]
    n = len(ids)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    fresh = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(fresh) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    shared = np.zeros((n, n), np.float32)
    width = max(1, CELLS // n)
    bounds = np.searchsorted(column, np.arange(0, int(often.sum()) + width, width))
    for begin, end, base in zip(bounds[:-1], bounds[1:], range(0, int(often.sum()) + width, width), strict=False):
        dense = np.zeros((n, width), np.float32)
        dense[owner[begin:end], column[begin:end] - base] = 1
        shared += dense @ dense.T
    shared = np.rint(shared).astype(np.int64)
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    return ids[stars(linked & pairs)]


def confirmed_links(texts: DataFrame, plan: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): star edges of confirmed links. ``texts`` has the packed texts of all members."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("packed").to_pylist(), batch.column("size").to_pylist(), strict=True)
            items = [shingles(unpack(*text).decode(), size).tobytes() for text in texts]
            yield pa.RecordBatch.from_pydict({"node": batch.column("node"), "items": pa.array(items, pa.binary())})

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", ignore_index=True)
        items = [np.frombuffer(x, np.uint64) for x in frame["items"]]
        sketches = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), -1)
        edges = confirm(frame["node"].to_numpy(), items, sketches, frame["left"].to_numpy(), percent)
        return pd.DataFrame({"u": edges[:, 0], "v": edges[:, 1]})

    full = texts.mapInArrow(sets, "node long, items binary").join(plan, "node")
    full = full.withColumn("left", F.col("own") == F.col("pair.a")).select("node", "items", "sketch", "family", "pair", "left")
    return full.groupBy("family", "pair").applyInPandas(compare, "u long, v long")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each input row.

    Documents link if 100 * |intersection| >= percent * |union| of their sets of
    ``size``-word shingles. Texts of fewer words are one shingle; null texts, empty
    texts and texts of white space have an empty set and link with nothing.
    ``component_id`` is the smallest id reachable. Rows that repeat an id are one node
    if their texts are equal; if not, they are taken as linked through their id.
    Null ids link like others within this call, under an id below all others, and
    come back as null.
    """
    lowest = F.lit(-(1 << 63))
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), lowest).alias("doc_id"), F.col(text_col).alias("text"))
    rows = staged(described(source, size), "minhash")
    nodes = rows.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("node"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")
    )
    nodes = staged(nodes, "sets")
    families = components(bucket_ties(nodes)).withColumnRenamed("component", "family")
    sized = nodes.groupBy("node").agg(F.max("n_shingles").alias("n_shingles"), F.any_value("sketch").alias("sketch"))
    plan = staged(tasks(families.join(sized, "node"), percent / 100), "families")
    wanted = plan.select("node").distinct()
    # the members grow with the documents, so they are not broadcast at any size
    texts = packed_texts(source.withColumnRenamed("doc_id", "node"), "node").join(wanted.hint("merge"), "node")
    same_id = nodes.join(rows.where("key is not null").select("key", "doc_id"), "key").where("node <> doc_id")
    repeated = rows.where("key is not null").groupBy("doc_id").agg(F.count_distinct("key").alias("n")).where("n > 1")
    through_id = same_id.join(repeated.select("doc_id"), "doc_id").select(F.col("doc_id").alias("u"), F.col("node").alias("v"))
    links = confirmed_links(texts, plan, size, percent).union(through_id)
    labels = components(links)
    found = nodes.select("key", "node").join(labels, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component_id")
    )
    full = rows.where("key is not null").select("doc_id", "n_shingles", "key").join(found, "key").drop("key")
    none = rows.where("key is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    every = full.union(none).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    back = lambda name: F.when(F.col(name) != lowest, F.col(name)).alias(name)
    return every.select(back("doc_id"), "n_shingles", back("component_id"), "kept")

"""Alignment of two tokenizers over the same texts, by divide and conquer at shared cuts.

Both tokenizers cut the bytes of a text into tokens. A byte offset where tokens of both
end is a shared cut. An interval of tokens looks for a shared cut near its middle: ends
of the first tokenizer, from the middle outwards, are located by bisection among the ends
of the second one. A cut divides the interval in two, which are treated alike; an interval
without one is a leaf, a group of tokens that correspond as a whole. All intervals of
a block of texts take a step at a time, so a step is a few array operations.

Texts are first cut to words at single spaces, where both tokenizers always end a token, and
every different word of a block is tokenized and divided once; a text with other white space
beside a space is one unit as a whole. What is known of units is gathered for texts by index.

Tokens of both sides whose bytes overlap are linked. Links are counted over the corpus as
documents that hold them; every block of texts carries a dictionary of its id pairs, so
that a pair travels once per block and not once per document.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.llm.common import packed_numbers, ragged, send_file, staged, text_blocks, unpacked_numbers
from tidewheel.llm.tokens import Ragged, byte_letters, numbered

# A space at the beginning or the end, or with white space after it, or a sign that stands
# for a space: no place to cut.
_WHOLE = re.compile(r"^ | (?:\s|$)|▁")
BLOCK = 1 << 20
"""Bytes of text that share a dictionary."""
# Fixed value: how byte-level BPE cuts a text before it merges.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# A unit that a piece may reach beyond if another one stands before or behind it.
_APART = re.compile(r"^\s| ")
SLICE = 1 << 18
"""Characters that are given to a tokenizer at a time; its results are large objects."""


def byte_lists(tokens: dict[int, bytes]) -> Ragged:
    """The bytes of each token, by id."""
    rows = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    return Ragged(np.frombuffer(b"".join(rows), np.uint8), np.array(list(map(len, rows)), np.int64))


class ByteTokenizer:
    """A byte-level BPE file; strings of special tokens in a text are plain text.

    The vocabulary's ids are the order of its merges, so a merge is known by what it makes.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        values = {letter: value for value, letter in enumerate(byte_letters())}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {
            bytes(map(values.__getitem__, name)): i for name, i in spec["model"]["vocab"].items() if name not in special
        }
        self.model = tiktoken.Encoding("byte_bpe", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.bytes = byte_lists({i: token for token, i in ranks.items()})

    def encode(self, texts: list[str]) -> Ragged:
        """Ids of each text after a space. Words that a piece always ends at are given to the
        library together, and told apart by their bytes."""
        joint = [i for i, text in enumerate(texts) if text and not _APART.search(text)]
        alone = sorted(set(range(len(texts))) - set(joint))
        parts, rows = [], []
        for some in slices(joint, [len(texts[i]) for i in joint]):
            ids = np.array(self.model.encode_ordinary(" " + " ".join([texts[i] for i in some])), np.int64)
            words = np.cumsum([len(texts[i].encode("utf-8", "replace")) + 1 for i in some])
            ends = np.cumsum(self.bytes.sizes[ids])
            last = np.searchsorted(ends, words)
            if len(ids) != last[-1] + 1 or (ends[last] != words).any():
                alone += some  # a token that goes on beyond a word
                continue
            parts.append(Ragged(ids, np.diff(last, prepend=-1)))
            rows += some
        parts.append(listed([self.model.encode_ordinary(" " + texts[i]) for i in alone]))
        place = np.empty(len(texts), np.int64)
        place[rows + alone] = np.arange(len(texts))
        return Ragged(*(np.concatenate([getattr(x, name) for x in parts]) for name in ("flat", "sizes"))).gather(place)


class PieceTokenizer:
    """A sentence-piece model with byte fallback, which puts a space before a text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        tokens = {}
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            tokens[i] = bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
        self.bytes = byte_lists(tokens)
        #: whether a token always ends before a space
        self.ends_at_space = not any(b" " in token.lstrip(b" ") for token in tokens.values())

    def encode(self, texts: list[str]) -> Ragged:
        found = [listed(self.model.encode(part, num_threads=1)) for part in slices(texts, list(map(len, texts)))]
        none = np.zeros(0, np.int64)
        return Ragged(*(np.concatenate([none, *(getattr(x, name) for x in found)]) for name in ("flat", "sizes")))


def listed(lists: list[list[int]]) -> Ragged:
    sizes = np.array(list(map(len, lists)), np.int64)
    return Ragged(np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes)


@dataclass
class Tokens:
    """Tokens of all units of a block: ids, where each ends in the joined bytes of the
    units, and how many each unit has."""

    ids: np.ndarray
    ends: np.ndarray
    counts: np.ndarray


def units(text: str | None, two: PieceTokenizer) -> list[str]:
    """The parts of a text that are tokenized on their own, each after a space."""
    if not text:
        return []
    return [text] if not two.ends_at_space or _WHOLE.search(text) else text.split(" ")


def slices(items: list, sizes: list[int]) -> Iterator[list]:
    """The items in runs of about ``SLICE`` characters, one item at least."""
    begin, held = 0, 0
    for at, size in enumerate(sizes):
        if held and held + size > SLICE:
            yield items[begin:at]
            begin, held = at, 0
        held += size
    if begin < len(items):
        yield items[begin:]


def tokenized(parts: list[str], one: ByteTokenizer, two: PieceTokenizer) -> tuple[Tokens, Tokens, np.ndarray]:
    """Tokens of both for every unit, and whether both give it back byte by byte after a
    space; units that they do not give back have no tokens."""
    ids = one.encode(parts), two.encode(parts)
    raw = [b" " + text.encode("utf-8", "replace") for text in parts]
    want = Ragged(np.frombuffer(b"".join(raw), np.uint8), np.array(list(map(len, raw)), np.int64))
    good = np.ones(len(parts), bool)
    for tokenizer, own in zip((one, two), ids, strict=True):
        given = tokenizer.bytes.inside(own)
        good &= given.sizes == want.sizes
        rows = np.flatnonzero(good)
        differ = given.gather(rows).flat != want.gather(rows).flat
        good[np.unique(np.repeat(rows, want.sizes[rows])[differ])] = False
    out = []
    for tokenizer, own in zip((one, two), ids, strict=True):
        kept = own.gather(np.flatnonzero(good))
        out.append(Tokens(kept.flat, np.cumsum(tokenizer.bytes.sizes[kept.flat]), np.where(good, own.sizes, 0)))
    return *out, good


def group_ends(one: Tokens, two: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups end, as numbers of tokens of either side, in order."""
    whole = np.flatnonzero(one.counts)
    a1, b1 = np.cumsum(one.counts)[whole], np.cumsum(two.counts)[whole]
    a0, b0 = a1 - one.counts[whole], b1 - two.counts[whole]
    tried = np.zeros(len(whole), np.int64)
    leaves = [np.zeros((2, 0), np.int64)]
    while len(a0):
        inner = a1 - a0 - 1  # ends of the first side that may be cuts
        leaf = (tried >= inner) | (b1 - b0 < 2)
        leaves.append(np.stack([a1[leaf], b1[leaf]]))
        a0, a1, b0, b1, tried, inner = (x[~leaf] for x in (a0, a1, b0, b1, tried, inner))
        # from the middle outwards, one end first, then as many as have been tried
        group, place = ragged(np.minimum(np.maximum(tried, 1), inner - tried))
        nth = tried[group] + place
        end = a0[group] + (inner[group] - 1) // 2 + np.where(nth % 2, (nth + 1) // 2, -(nth // 2))
        cut = one.ends[end]
        other = np.searchsorted(two.ends, cut)
        hit = np.flatnonzero((other < b1[group] - 1) & (two.ends[np.minimum(other, len(two.ends) - 1)] == cut))
        found, first = np.unique(group[hit], return_index=True)
        a, b = end[hit[first]] + 1, other[hit[first]] + 1
        still = np.ones(len(a0), bool)
        still[found] = False
        tried = np.append(tried[still] + np.minimum(np.maximum(tried, 1), inner - tried)[still], np.zeros(2 * len(a), int))
        a0, a1 = np.concatenate([a0[still], a0[found], a]), np.concatenate([a1[still], a, a1[found]])
        b0, b1 = np.concatenate([b0[still], b0[found], b]), np.concatenate([b1[still], b, b1[found]])
    ends = np.concatenate(leaves, axis=1)
    return tuple(ends[:, np.argsort(ends[0])])


def links(one: Tokens, two: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all pairs that share bytes: one pair for each stretch between ends."""
    both = np.concatenate([one.ends, two.ends])
    order = np.argsort(both, kind="stable")  # merges two sorted runs
    ends, ours = both[order], order < len(one.ends)
    fresh = np.flatnonzero(np.append(True, ends[1:] != ends[:-1])[: len(ends)])
    return (np.cumsum(ours) - ours)[fresh], (np.cumsum(~ours) - ~ours)[fresh]


def group_texts(one: Tokens, two: Tokens) -> tuple[pa.Array, np.ndarray]:
    """The groups of each unit as ``a1,a2|b1;a3|b2,b3``, and their number."""
    a_ends, b_ends = group_ends(one, two)
    sides = []
    for side, ends in ((one, a_ends), (two, b_ends)):
        ids = pa.array(side.ids).cast(pa.string())
        sides.append(pa.compute.binary_join(pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), ids), ","))
    groups = pa.compute.binary_join_element_wise(*sides, "|")
    offsets = np.append(0, np.searchsorted(a_ends, np.cumsum(one.counts), "right")).astype(np.int32)
    return pa.compute.binary_join(pa.ListArray.from_arrays(offsets, groups), ";"), np.diff(offsets).astype(np.int64)


OUTPUTS = {
    "n_a": "long",
    "n_b": "long",
    "n_groups": "long",
    "n_links": "long",
    "groups_sha256": "string",
    "groups": "string",
    "n_best": "long",
    "count_sum": "long",
}
_LOCAL = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
_LOADED: dict[tuple[str, str], tuple[ByteTokenizer, PieceTokenizer]] = {}


def loaded(one: str, two: str) -> tuple[ByteTokenizer, PieceTokenizer]:
    """The two tokenizers, of one application at a time, in this Python worker."""
    if (one, two) not in _LOADED:
        _LOADED.clear()
        _LOADED[one, two] = ByteTokenizer(SparkFiles.get(one)), PieceTokenizer(SparkFiles.get(two))
    return _LOADED[one, two]


def align(docs: DataFrame, byte_path: str, piece_path: str, text_col: str = "text", keep_groups: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, and those of ``OUTPUTS``.

    ``n_a`` and ``n_b`` count tokens, ``groups`` lists the groups of ids (null unless
    ``keep_groups``), ``groups_sha256`` is their digest, '' without tokens, ``n_links``
    counts overlapping pairs of tokens; ``count_sum`` adds up, over links, how many
    documents of the corpus hold the id pair, and ``n_best`` counts the links whose pair is
    in as many documents as any pair with the same first id.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have
    no tokens, and zeros. Each row is a document, whether or not its id repeats or is null.
    Input columns named like an output are replaced. An empty table gives an empty one.

    Texts are tokenized once, in a narrow pass whose result is written to the shared
    folder: the pairs of each document as numbers in the dictionary of its block, and the
    dictionaries. Dictionaries meet in a partial sum; a pair that is in every block is
    one row a block then, which adaptive execution splits. A task holds one block of
    documents and its dictionary, which has no more pairs than the block has links.
    """
    spark = docs.sparkSession
    names = []
    for path, suffix in ((byte_path, ".json"), (piece_path, ".model")):
        with open(path, "rb") as file:
            names.append(send_file(spark, file.read(), suffix))
    kept = [c for c in docs.columns if c.lower() not in {*OUTPUTS, text_col.lower()}]
    row = T.StructType([docs.schema[c] for c in kept])
    schema = T.StructType().add("block", "long").add("row", row)
    for name in _LOCAL:
        schema.add(name, OUTPUTS[name])
    schema.add("pairs", "binary").add("times", "binary").add("a", "binary").add("b", "binary").add("held", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = loaded(*names)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in text_blocks(batch, "text", BLOCK):
                yield _block(part, block, kept, *tokenizers, keep_groups)
                block += 1

    # a struct of all columns, so that no name can clash
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(text_col).alias("text"))
    table = staged(rows.mapInArrow(run, schema), "align")
    pairs = table.where("a is not null").select("block", "a", "b", "held").mapInArrow(
        _pairs, "block long, number int, a int, b int, held int"
    )
    total = pairs.groupBy("a", "b").agg(F.sum("held").alias("total"))
    most = total.groupBy("a").agg(F.max("total").alias("most"))
    judged = total.join(most, "a").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    # written, so that both sides of the next join are plain exchanges, which can be split
    judged = staged(judged, "pairs")
    marks = pairs.join(judged, ["a", "b"]).select("block", "number", "total", "best")
    local = table.where("a is null").select("block", "row", *_LOCAL, "pairs", "times")
    out = T.StructType().add("row", row)
    for name, kind in OUTPUTS.items():
        out.add(name, kind)
    found = local.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(_summed, out)
    return found.select("row.*", *OUTPUTS)


def _block(part: pa.RecordBatch, block: int, kept: list[str], one, two, keep_groups: bool) -> pa.RecordBatch:
    """A row for each document, and a last one with the dictionary of the block."""
    cut = [units(text, two) for text in part.column("text").to_pylist()]
    different, which = numbered([x for own in cut for x in own])
    a, b, good = tokenized(different, one, two)
    sizes = np.array(list(map(len, cut)), np.int64)
    doc = np.repeat(np.arange(len(cut)), sizes)
    whole = np.ones(len(cut), bool)
    whole[doc[~good[which]]] = False
    items = Ragged(which[whole[doc]], np.where(whole, sizes, 0))
    texts, n_groups = group_texts(a, b)
    joined = pa.ListArray.from_arrays(np.append(0, np.cumsum(items.sizes)).astype(np.int32), texts.take(pa.array(items.flat)))
    texts = pa.compute.binary_join(joined, ";").to_pylist()
    first, second = links(a, b)
    unit = np.repeat(np.arange(len(different)), a.counts)[first]
    pairs, number = np.unique(a.ids[first] << 32 | b.ids[second], return_inverse=True)
    linked = Ragged(number, np.bincount(unit, minlength=len(different))).inside(items)
    rows, width = part.num_rows, max(len(pairs), 1)
    held, times = np.unique(np.repeat(np.arange(rows), linked.sizes) * width + linked.flat, return_counts=True)
    doc, number = np.divmod(held, width)
    stops = np.cumsum(np.bincount(doc, minlength=rows))
    cells = list(zip((stops - np.bincount(doc, minlength=rows)).tolist(), stops.tolist(), strict=True))
    more = lambda values, kind: pa.concat_arrays([pa.array(values, kind), pa.nulls(1, kind)])
    total = lambda values: Ragged(values, np.ones(len(values), np.int64)).inside(items)
    sums = [_per_list(total(x)) for x in (a.counts, b.counts, n_groups)]
    row = part.column("row")
    digest = [hashlib.sha256(x.encode()).hexdigest() if n else "" for x, n in zip(texts, sums[0], strict=True)]
    seen = np.bincount(number, minlength=len(pairs))
    used = np.flatnonzero(seen)  # a unit of a text that has no tokens may be the only one with a pair
    number = np.searchsorted(used, number)
    dictionary = [
        pa.array([None] * rows + [packed_numbers(x[used])], pa.binary()) for x in (pairs >> 32, pairs & 0xFFFFFFFF, seen)
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * (rows + 1), pa.int64()),
            pa.concat_arrays([row, pa.nulls(1, row.type)]),
            *(more(x, pa.int64()) for x in sums),
            more(linked.sizes, pa.int64()),
            more(digest, pa.string()),
            more(texts if keep_groups else [None] * rows, pa.string()),
            # in order, so that gaps between numbers are small
            more([packed_numbers(np.diff(number[x:y], prepend=0)) for x, y in cells], pa.binary()),
            more([packed_numbers(times[x:y]) for x, y in cells], pa.binary()),
            *dictionary,
        ],
        ["block", "row", *_LOCAL, "pairs", "times", "a", "b", "held"],
    )


def _per_list(values: Ragged) -> np.ndarray:
    """The sum of each list."""
    ends = np.cumsum(values.sizes)
    totals = np.append(0, np.cumsum(values.flat))
    return totals[ends] - totals[ends - values.sizes]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each pair of a block's dictionary."""
    for batch in batches:
        for row in batch.to_pylist():
            a, b, held = (unpacked_numbers(row[name]).astype(np.int32) for name in ("a", "b", "held"))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(a), row["block"])),
                    pa.array(np.arange(len(a), dtype=np.int32)),
                    *map(pa.array, (a, b, held)),
                ],
                ["block", "number", "a", "b", "held"],
            )


def _summed(docs: pa.Table, marks: pa.Table) -> pa.Table:
    """The documents of a block, with sums over their links."""
    number = np.asarray(marks["number"], np.int64)
    total = np.zeros(len(number), np.int64)
    best = np.zeros(len(number), np.int64)
    total[number] = np.asarray(marks["total"])
    best[number] = np.asarray(marks["best"], np.int64)
    n_best, count_sum = [], []
    for pairs, times in zip(docs["pairs"].to_pylist(), docs["times"].to_pylist(), strict=True):
        place, often = np.cumsum(unpacked_numbers(pairs)), unpacked_numbers(times)
        n_best.append(int(best[place] @ often))
        count_sum.append(int(total[place] @ often))
    return pa.table(
        [docs["row"], *(docs[name] for name in _LOCAL), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
        ["row", *OUTPUTS],
    )

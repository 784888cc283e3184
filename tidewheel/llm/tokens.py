"""BPE encoding and decoding with a lexicon of the corpus's frequent words.

The words of the whole corpus are counted; the most frequent ones are encoded once
and compiled into a minimal acyclic transducer (``lexicon``) that tasks map into
memory. A task cuts a block of texts to words, looks each different word up in the
transducer, all of them a transition at a time, merges those that are not there exactly,
in the order of the merge ranks, and gathers the ids of the texts by index. Nothing
outlives its block but the vocabulary and the mapped lexicon.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm import lexicon
from tidewheel.llm.common import put, ragged, schema_with, send_file, staged, text_blocks

LEXICON_WORDS = 50_000
COUNTED = 250_000
"""Distinct words that a task counts before it hands on their sums."""
LONG_WORD = 400
"""Bytes from which a word is merged on a heap instead of in step with others."""
EXACT_COUNTS = 1 << 12
PIECE, SPECIAL = "\0p", "\0s"
"""Marks of items that are not cut again; no other item holds a NUL."""

_PLAIN = re.compile(r"[^\W\d_]+|'s|'t|'re|'ve|'m|'ll|'d|\d|(?:[^\s\w]|_)+")
_FULL = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# Texts of these characters are cut alike by both patterns.
_OTHER = re.compile(r"[^\t-\r -~¡-±´-¸º»¿-ɏ‐-‧]")
_SPACE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable stand-in for each byte: itself if visible in Latin-1, else the
    next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


@dataclass
class Ragged:
    """Lists of numbers, one after the other."""

    flat: np.ndarray
    sizes: np.ndarray

    def gather(self, rows: np.ndarray) -> Ragged:
        """The lists of these numbers, in this order."""
        sizes = self.sizes[rows]
        group, place = ragged(sizes)
        return Ragged(self.flat[(np.cumsum(self.sizes) - self.sizes)[rows][group] + place], sizes)

    def inside(self, outer: Ragged) -> Ragged:
        """Lists of lists, joined: ``outer`` lists numbers of lists of this one."""
        found = self.gather(outer.flat)
        totals = np.append(0, np.cumsum(found.sizes))
        ends = np.cumsum(outer.sizes)
        return Ragged(found.flat, totals[ends] - totals[ends - outer.sizes])


def numbered(values: list[str]) -> tuple[list[str], np.ndarray]:
    """The different values, and for each value which one it is."""
    found = pa.array(values, pa.string()).dictionary_encode()
    return found.dictionary.to_pylist(), np.asarray(found.indices, np.int64)


class Tokenizer:
    """A BPE vocabulary with word ends, read from a tokenizer file.

    Special tokens are cut out of the raw text first; what is left is normalised
    (NFC, white space, lower case by code point), cut into pieces, and each piece
    merged on its own.
    """

    def __init__(self, path: str, words: str | None = None) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        end = model["end_of_word_suffix"] or ""
        ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: token for token, i in (ids | self.special).items()}
        self.width = max(names) + 1
        self.names = pa.array([names.get(i, "") for i in range(self.width)], pa.string())
        options = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, options)) + ")") if options else None
        letters = byte_letters()
        self.byte_ids = np.array([[ids[letter], ids[letter + end]] for letter in letters], np.int64)
        keys = np.array([ids[a] * self.width + ids[b] for a, b in pairs] or [-1], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order
        self.none = len(keys)
        self.made = np.array([ids[a + b] for a, b in pairs] or [-1], np.int64)
        # Words may be merged in step if a merge only uses what lower ranks have made.
        made = {}
        for rank, (a, b) in enumerate(pairs):
            made.setdefault(a + b, rank)
        self.ordered = len(made) == len(pairs) and all(
            made.get(x, -1) < rank for rank, pair in enumerate(pairs) for x in pair
        )
        self.words = lexicon.Transducer(words) if words else None

    def items(self, text: str) -> list[str]:
        """What a text is cut to in order: chunks between white space, which are still to
        be cut to pieces, or marked pieces and special tokens."""
        out: list[str] = []
        for n, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if n % 2:
                out.append(SPECIAL + part)
            elif not _OTHER.search(part):
                out += unicodedata.normalize("NFC", part).lower().split()
            else:
                # White space by its Unicode property; final sigma is no case of its own here.
                part = _SPACE.sub(" ", unicodedata.normalize("NFC", part))
                out += [PIECE + piece for piece in _FULL.findall(part.replace("Σ", "σ").lower())]
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], self.none)

    def merge(self, letters: np.ndarray, sizes: np.ndarray) -> Ragged:
        """Exact merges of all words, which are stretches of ``letters`` (bytes).

        Every word merges its pair of lowest rank, wherever the pair stands, from the left;
        what that makes has pairs of higher ranks only. All words take such a step at once.
        """
        last = np.zeros(len(letters), bool)
        last[np.cumsum(sizes) - 1] = True
        symbols = self.byte_ids[letters, last.astype(int)]
        word = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), self.none)
        inner = np.flatnonzero(~last)
        rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        parts = []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(word)))
            least = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            done = least == self.none
            if done.any():
                parts.append((word[done], symbols[done]))
                symbols, word, rank, least = (x[~done] for x in (symbols, word, rank, least))
            taken = rank == least
            # Of pairs that overlap, as in a repeated letter, every second one is left out.
            link = np.flatnonzero(taken[1:] & taken[:-1]) + 1
            if len(link):
                chain = np.flatnonzero(taken & ~np.append(False, taken[:-1]))
                start = chain[np.searchsorted(chain, link) - 1]
                taken[link[(link - start) % 2 == 1]] = False
            at = np.flatnonzero(taken)
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]  # none at the end of a word, looked up anew elsewhere
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            at = at - np.arange(len(at))
            changed = np.zeros(len(word), bool)
            changed[at] = changed[at[at > 0] - 1] = True
            near = np.flatnonzero(changed[:-1])
            inside = word[near] == word[near + 1]
            rank[near[~inside]] = self.none
            near = near[inside]
            rank[near] = self.ranks(symbols[near], symbols[near + 1])
            if len(rank):
                rank[-1] = self.none
        word = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in parts)])
        flat = np.concatenate([np.zeros(0, np.int64), *(x for _, x in parts)])
        return Ragged(flat[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(sizes)))

    def merge_one(self, word: bytes) -> list[int]:
        """Exact merges of a word of any length, with a heap over a linked list."""
        letters = np.frombuffer(word, np.uint8)
        parts = self.byte_ids[letters, (np.arange(len(letters)) == len(letters) - 1).astype(int)].tolist()
        size, width = len(parts), self.width
        table = self._table()
        after, before = [*range(1, size + 1)], [*range(-1, size - 1)]
        pairs = [a * width + b for a, b in zip(parts, parts[1:])]
        heap = [(table[p], i, p) for i, p in enumerate(pairs) if p in table]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if j >= size or parts[i] < 0 or parts[i] * width + parts[j] != pair:
                continue
            parts[i], parts[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < size:
                    made = parts[left] * width + parts[right]
                    if made in table:
                        heapq.heappush(heap, (table[made], left, made))
        return [part for part in parts if part >= 0]

    def _table(self) -> dict[int, int]:
        if not hasattr(self, "_ranks"):
            self._ranks = dict(zip(self.keys.tolist(), self.rank_of.tolist(), strict=True))
        return self._ranks

    def ids_of(self, pieces: list[str]) -> Ragged:
        """Token ids of different pieces: from the lexicon if they are there, else merged."""
        raw = [x.encode("utf-8", "replace") for x in pieces]
        sizes = np.array([len(x) for x in raw], np.int64)
        letters = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.cumsum(sizes) - sizes
        number = np.full(len(raw), -1, np.int64)
        if self.words is not None:
            number = self.words.find_all(letters, starts, sizes)
        special = np.array([x.startswith(SPECIAL) for x in pieces], bool)
        one = (number < 0) & (special | (sizes >= LONG_WORD) | (not self.ordered))
        many = (number < 0) & ~one
        parts = []  # rows, and their lists
        if (number >= 0).any():
            edges = np.asarray(self.words.starts, np.int64)
            table = Ragged(np.asarray(self.words.ids, np.int64), np.diff(edges))
            parts.append((number >= 0, table.gather(number[number >= 0])))
        if many.any():
            group, place = ragged(sizes[many])
            parts.append((many, self.merge(letters[starts[many][group] + place], sizes[many])))
        if one.any():
            lists = [
                [self.special[pieces[i].removeprefix(SPECIAL)]] if special[i] else self.merge_one(raw[i])
                for i in np.flatnonzero(one)
            ]
            parts.append((one, Ragged(np.array([x for ids in lists for x in ids], np.int64), np.array(list(map(len, lists))))))
        # each row lies in one part: number the lists of all parts, and put them in order
        place = np.empty(len(raw), np.int64)
        at = 0
        for rows, lists in parts:
            place[rows] = at + np.arange(len(lists.sizes))
            at += len(lists.sizes)
        none = np.zeros(0, np.int64)
        joined = Ragged(
            np.concatenate([none, *(x.flat for _, x in parts)]), np.concatenate([none, *(x.sizes for _, x in parts)])
        )
        return joined.gather(place)

    def encode(self, texts: list[str]) -> Ragged:
        """Token ids of whole texts."""
        items = [self.items(text) for text in texts]
        different, which = numbered([x for own in items for x in own])
        cut = [[x.removeprefix(PIECE)] if x[:1] == "\0" else _PLAIN.findall(x) for x in different]
        pieces, piece = numbered([x for own in cut for x in own])
        sizes = np.array(list(map(len, cut)), np.int64)
        ids_of_items = self.ids_of(pieces).inside(Ragged(piece, sizes))
        return ids_of_items.inside(Ragged(which, np.array(list(map(len, items)), np.int64)))

    def decode(self, ids: Ragged) -> pa.Array:
        """The texts that lists of ids decode to, special tokens included."""
        offsets = np.append(0, np.cumsum(ids.sizes)).astype(np.int32)
        return pa.compute.binary_join(pa.ListArray.from_arrays(offsets, self.names.take(pa.array(ids.flat))), " ")


def packed(ids: Ragged) -> pa.Array:
    """Each list as little-endian unsigned 32-bit integers."""
    offsets = np.append(0, 4 * np.cumsum(ids.sizes)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.flat.astype("<u4").tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(ids.sizes), buffers)


_LOADED: dict[tuple[str, str | None], Tokenizer] = {}


def loaded(vocabulary: str, words: str | None = None) -> Tokenizer:
    """The tokenizer of this Python worker, from files that Spark sent to its executor.

    One at a time stays loaded: a vocabulary as arrays, and a lexicon in the page cache.
    """
    key = vocabulary, words
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizer(SparkFiles.get(vocabulary), words and SparkFiles.get(words))
    return _LOADED[key]


def word_counts(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; tasks add up their own words first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(vocabulary)
        items: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            counts: Counter[str] = Counter()
            for item, n in items.items():
                if item[:2] == PIECE:
                    counts[item[2:]] += n
                elif item[:2] != SPECIAL:
                    for piece in _PLAIN.findall(item):
                        counts[piece] += n
            items.clear()
            return pa.RecordBatch.from_pydict(
                {"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )

        for batch in batches:
            for text in batch.column(text_col).to_pylist():
                items.update(tokenizer.items(text or ""))
                if len(items) > COUNTED:
                    yield flush()
        if items:
            yield flush()

    counted = docs.select(text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """Words that are found twice or more, as many whole classes of the most frequent
    ones as ``size`` words hold. Counts up to ``EXACT_COUNTS`` are classes of their own, above
    that a class spans a sixteenth of a doubling; so the histogram that comes to the driver
    has a few thousand rows, and after it ``size`` words at most."""
    n = F.col("n")
    many = F.lit(EXACT_COUNTS) + F.floor(16 * F.log2(n / F.lit(EXACT_COUNTS)))
    rank = F.when(n <= EXACT_COUNTS, n).otherwise(many).cast("long")
    held = staged(counts.where((n > 1) & (F.length("word") < 100)).withColumn("rank", rank), "words")
    left, least = size, None
    for row in held.groupBy("rank").count().orderBy(F.desc("rank")).collect():
        if row["count"] > left:
            break
        left, least = left - row["count"], row["rank"]
    return [] if least is None else [row["word"] for row in held.where(F.col("rank") >= least).select("word").collect()]


def compile_lexicon(docs: DataFrame, path: str, size: int = LEXICON_WORDS, text_col: str = "text") -> tuple[str, str]:
    """Names of two files at the executors: the vocabulary, and the lexicon of frequent
    words of all texts, ``size`` at most."""
    spark = docs.sparkSession
    with open(path, "rb") as file:
        vocabulary = send_file(spark, file.read(), ".json")
    words = sorted(frequent_words(word_counts(docs, vocabulary, text_col), size))
    ids = Tokenizer(path).ids_of(words)
    stops = np.cumsum(ids.sizes)
    entries = {w: ids.flat[b - n : b].tolist() for w, b, n in zip(words, stops, ids.sizes, strict=True)}
    return vocabulary, send_file(spark, lexicon.build(entries), ".lex")


def encode(docs: DataFrame, path: str, size: int = LEXICON_WORDS, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (binary, little-endian unsigned 32-bit integers) and
    ``decoded`` appended; whole texts, in one narrow pass after the count.

    Input columns of these names are replaced. Null and empty texts have no ids and decode
    to an empty text; rows that repeat are encoded alike, an id plays no part. An empty
    table gives an empty one. Lone surrogates cannot occur in Spark strings.
    """
    vocabulary, words = compile_lexicon(docs, path, size, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(vocabulary, words)
        for batch in batches:
            for block in text_blocks(batch, text_col):
                ids = tokenizer.encode([text or "" for text in block.column(text_col).to_pylist()])
                yield put(block, {"token_ids": packed(ids), "decoded": tokenizer.decode(ids)})

    return docs.mapInArrow(run, schema_with(docs, token_ids="binary", decoded="string"))

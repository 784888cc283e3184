"""Periodic runs of words, found on a grammar instead of the text.

1. The words of a block of documents become numbers. Re-Pair turns them into a
   grammar that the documents of the block share: the most frequent pair of
   neighbours becomes a nonterminal wherever it stands, and in the same round so does
   every pair where no more frequent one touches it, until no pair occurs twice. What
   is left of a document is paired up level by level, so each document has one root.
2. A run lies across the boundary between the two halves of the lowest nonterminal
   that derives all of it. So for each nonterminal, once however often it occurs, the
   runs across its boundary are computed: a run of four periods has two of them on
   one side of the boundary, which are a square beside it.
3. Runs are carried to all positions where the derivation uses their nonterminal.
   Branches without runs are left out. Intervals that lie in one of the same period are
   what a nonterminal sees of a longer run; they are merged into it.

Equality of stretches is asked of prefix hashes; every run is compared word by word
in the end, and a document in which one does not hold is searched directly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewheel.llm.common import put, ragged, schema_with, text_blocks

LEAST = 6
TIMES = 4
"""A run has at least ``LEAST`` words and ``TIMES`` periods."""
CHUNK = 1 << 21
"""Pairs of boundary and period that are looked at together."""

_PRIME = (1 << 31) - 1
_BASES = (1_103_515_245, 1_664_525_013)

Change = Callable[[list[bytes], dict], list[bytes]]


class Grammar:
    """Rules of two symbols each; numbers below ``words`` are words.

    ``rounds`` holds where each round's rules begin: a rule uses symbols of earlier
    rounds only. ``place`` is one position in the text where a symbol is derived.
    """

    def __init__(self, seq: np.ndarray, starts: np.ndarray) -> None:
        self.words = int(seq.max()) + 1 if len(seq) else 0
        self.left, self.right, self.place = [], [], []
        self.rounds = [self.words]
        self.size = np.ones(self.words, np.int64)
        self._seq, self._at = seq.astype(np.int64), np.arange(len(seq))
        self._last = np.zeros(len(seq), bool)
        self._last[np.append(starts[1:], len(seq)) - 1] = True
        self._live = np.ones(len(seq), bool)
        known = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while True:
            whole = self._live.all()
            if (taken := self._frequent()) is not None:
                known = self._replace(taken, known)
            elif whole:
                break
            else:
                self._live[:] = True  # a pair seen once may have come up again
        while (taken := self._neighbours()) is not None:
            known = self._replace(taken, known)
        self.roots = self._seq
        self.left, self.right, self.place = (
            np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (self.left, self.right, self.place)
        )

    def _keys(self, at: np.ndarray) -> np.ndarray:
        return self._seq[at] << 32 | self._seq[at + 1]

    def _frequent(self) -> np.ndarray | None:
        """Places of the pairs that this round replaces; None if no pair occurs twice.

        Pairs seen once are left out of the count until a neighbour of theirs changes.
        """
        at = np.flatnonzero(self._live[:-1] & ~self._last[:-1])
        keys = self._keys(at)
        order = np.argsort(keys, kind="stable")
        held = keys[order]
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.zeros(0, int)
        counts = np.diff(np.append(first, len(held)))
        often = counts > 1
        if not often.any():
            self._live[at] = False
            return None
        # The more frequent a pair the lower its rank; pairs that occur once have none.
        none = len(counts)
        self._live[at[order[np.repeat(~often, counts)]]] = False
        ranks = np.full(none, none)
        few = np.flatnonzero(often)
        ranks[few[np.argsort(-counts[few], kind="stable")]] = np.arange(len(few))
        rank = np.full(len(self._seq) + 1, none)
        rank[at[order]] = np.repeat(ranks, counts)
        here, before, after = rank[:-1], np.append(none, rank[:-2]), rank[1:]
        able = (here < none) & (here <= before) & (here <= after)
        # Of equal neighbours, as in a repeated word, every second one is replaced.
        chain = np.flatnonzero((here < none) & (here != before))
        link = np.flatnonzero((here < none) & (here == before))
        if len(link):
            start = chain[np.searchsorted(chain, link) - 1]
            able[link[(link - start) % 2 == 1]] = False
        return np.flatnonzero(able)

    def _neighbours(self) -> np.ndarray | None:
        """Every second place of each document."""
        if self._last.all():
            return None
        first = np.flatnonzero(np.append(True, self._last[:-1]))
        _, place = ragged(np.diff(np.append(first, len(self._seq))))
        return np.flatnonzero((place % 2 == 0) & ~self._last)

    def _replace(self, at: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Puts nonterminals in the place of the pairs at ``at``, those of earlier
        rounds if ``known`` has the pair; returns the pairs known from now on."""
        left, right = self._seq[at], self._seq[at + 1]
        keys, index, back = np.unique(self._keys(at), return_index=True, return_inverse=True)
        found = np.searchsorted(known[0], keys)
        old = np.zeros(len(keys), bool)
        inside = found < len(known[0])
        old[inside] = known[0][found[inside]] == keys[inside]
        ids = np.empty(len(keys), np.int64)
        ids[old] = known[1][found[old]]
        ids[~old] = self.rounds[-1] + np.arange((~old).sum())
        fresh, symbols = index[~old], ids[back]
        keys, ids = np.concatenate([known[0], keys[~old]]), np.concatenate([known[1], ids[~old]])
        order = np.argsort(keys, kind="stable")
        known = keys[order], ids[order]
        self.left.append(left[fresh])
        self.right.append(right[fresh])
        self.place.append(self._at[at[fresh]])
        self.rounds.append(self.rounds[-1] + len(fresh))
        self.size = np.append(self.size, self.size[left[fresh]] + self.size[right[fresh]])
        self._seq[at] = symbols
        self._last[at] = self._last[at + 1]
        keep = np.ones(len(self._seq), bool)
        keep[at + 1] = False
        self._live[at] = True
        self._live[np.maximum(at - 1, 0)] = True
        self._seq, self._at = self._seq[keep], self._at[keep]
        self._last, self._live = self._last[keep], self._live[keep]
        return known


class Prefixes:
    """Hashes of all prefixes of a sequence, by two moduli-and-base pairs."""

    def __init__(self, seq: np.ndarray) -> None:
        mixed = (seq.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        self.sums, self.powers = [], []
        for n, base in enumerate(_BASES):
            power = np.ones(len(seq) + 1, np.uint64)
            done, step = 1, base
            while done < len(power):
                some = power[done : 2 * done]
                some[:] = power[: len(some)] * np.uint64(step) % np.uint64(_PRIME)
                done, step = 2 * done, step * step % _PRIME
            values = (mixed >> np.uint64(8 + 20 * n)) % np.uint64(_PRIME)
            sums = np.zeros(len(seq) + 1, np.uint64)
            np.cumsum(values * power[:-1] % np.uint64(_PRIME), out=sums[1:])
            self.sums.append(sums % np.uint64(_PRIME))
            self.powers.append(power)

    def equal(self, a: np.ndarray, gap: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the ``length`` words from ``a`` are those from ``a + gap``."""
        b, prime = a + gap, np.uint64(_PRIME)
        out = np.ones(len(a), bool)
        for sums, powers in zip(self.sums, self.powers, strict=True):
            one = (sums[a + length] + prime - sums[a]) % prime * powers[gap] % prime
            out &= one == (sums[b + length] + prime - sums[b]) % prime
        return out

    def common(self, a: np.ndarray, gap: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words, at most ``most``, agree from ``a`` and ``a + gap`` on, or up to them."""
        low, high = np.zeros(len(a), np.int64), most.copy()
        while (todo := np.flatnonzero(low < high)).size:
            middle = (low[todo] + high[todo] + 1) // 2
            same = self.equal(a[todo] - middle if back else a[todo], gap[todo], middle)
            low[todo[same]] = middle[same]
            high[todo[~same]] = middle[~same] - 1
        return low


@dataclass
class Runs:
    """Runs as columns; ``owner`` is a nonterminal or a document."""

    owner: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    period: np.ndarray

    def take(self, rows: np.ndarray) -> Runs:
        return Runs(*(x[rows] for x in (self.owner, self.start, self.stop, self.period)))

    @staticmethod
    def joined(parts: list[Runs]) -> Runs:
        none = np.zeros(0, np.int64)
        return Runs(
            *(np.concatenate([none, *(getattr(p, x) for p in parts)]) for x in ("owner", "start", "stop", "period"))
        )

    def primitive(self) -> Runs:
        """Each interval with its smallest period only."""
        order = np.lexsort((self.period, self.stop, self.start, self.owner))
        x = self.take(order)
        same = (x.owner[1:] == x.owner[:-1]) & (x.start[1:] == x.start[:-1]) & (x.stop[1:] == x.stop[:-1])
        return x.take(np.flatnonzero(np.append(True, ~same)[: len(x.owner)]))


def boundary_runs(words: np.ndarray, prefixes: Prefixes, grammar: Grammar) -> Runs:
    """Runs across the boundary of each nonterminal, as far as it derives them;
    ``start`` and ``stop`` count from where the nonterminal begins."""
    sizes = grammar.size[grammar.words :]
    lefts = grammar.size[grammar.left]
    parts = []
    for behind in (False, True):
        side = lefts if behind else sizes - lefts
        tries = np.where(sizes >= LEAST, np.minimum(side // 2, sizes // TIMES), 0)
        some = np.flatnonzero(tries)
        ends = np.cumsum(tries[some])
        at = 0
        while at < len(some):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
            group, place = ragged(tries[some[at:stop]])
            rule, period = some[at:stop][group], place + 1
            middle = grammar.place[rule] + lefts[rule]
            one = middle - 1 - period if behind else middle
            rows = np.flatnonzero(words[one] == words[one + period])
            rule, period, middle = rule[rows], period[rows], middle[rows]
            first = middle - 2 * period if behind else middle
            rows = np.flatnonzero(prefixes.equal(first, period, period))
            parts.append(_extended(prefixes, grammar, rule[rows], period[rows], first[rows], sizes))
            at = stop
    return Runs.joined(parts).primitive()


def _extended(prefixes, grammar, rule, period, first, sizes) -> Runs:
    """The squares from ``first`` on, extended as far as they keep their period."""
    begin = grammar.place[rule]
    end = begin + sizes[rule]
    more = prefixes.common(first + period, period, end - first - 2 * period, back=False)
    less = prefixes.common(first, period, first - begin, back=True)
    start, stop = first - less, first + 2 * period + more
    rows = np.flatnonzero(stop - start >= np.maximum(LEAST, TIMES * period))
    return Runs(rule[rows], start[rows] - begin[rows], stop[rows] - begin[rows], period[rows])


def translated(grammar: Grammar, found: Runs, starts: np.ndarray) -> Runs:
    """``found`` at every position where the derivation of a document uses its
    nonterminal; ``owner`` is the document then."""
    rules = len(grammar.left)
    counts = np.bincount(found.owner, minlength=rules)
    offset = np.cumsum(counts) - counts
    below = np.zeros(grammar.words + rules, bool)
    for low, high in zip(grammar.rounds, grammar.rounds[1:], strict=False):
        rows = slice(low - grammar.words, high - grammar.words)
        below[low:high] = (counts[rows] > 0) | below[grammar.left[rows]] | below[grammar.right[rows]]
    symbol, place, doc = grammar.roots, starts, np.arange(len(starts))
    parts = []
    while True:
        rows = np.flatnonzero(below[symbol])
        if not len(rows):
            return Runs.joined(parts)
        rule, place, doc = symbol[rows] - grammar.words, place[rows], doc[rows]
        group, nth = ragged(counts[rule])
        one = offset[rule][group] + nth
        parts.append(Runs(doc[group], place[group] + found.start[one], place[group] + found.stop[one], found.period[one]))
        left, right = grammar.left[rule], grammar.right[rule]
        symbol = np.concatenate([left, right])
        place = np.concatenate([place, place + grammar.size[left]])
        doc = np.concatenate([doc, doc])


def merged(found: Runs) -> Runs:
    """Only intervals that no other one of the same document and period contains, each
    with its smallest period, in order of document, start and period."""
    order = np.lexsort((-found.stop, found.start, found.period, found.owner))
    x = found.take(order)
    if not len(order):
        return x
    # A later interval of the same group starts later; it is new if it also ends later.
    fresh = np.append(True, (x.owner[1:] != x.owner[:-1]) | (x.period[1:] != x.period[:-1]))
    group = np.cumsum(fresh) - 1
    reach = np.maximum.accumulate(group * (x.stop.max() + 1) + x.stop)
    longer = np.append(True, reach[1:] > reach[:-1])
    x = x.take(np.flatnonzero(fresh | longer)).primitive()
    return x.take(np.lexsort((x.period, x.start, x.owner)))


def direct(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, stop, period) of all runs of one document, period by period."""
    found = {}
    for period in range(len(words) // TIMES, 0, -1):
        same = np.append(np.append(False, words[period:] == words[:-period]), False).astype(np.int8)
        edges = np.flatnonzero(np.diff(same))
        for start, stop in zip(edges[::2].tolist(), (edges[1::2] + period).tolist(), strict=True):
            if stop - start >= max(LEAST, TIMES * period):
                found[start, stop] = period
    return sorted(((a, b, period) for (a, b), period in found.items()), key=lambda x: (x[0], x[2]))


def holds(words: np.ndarray, starts: np.ndarray, runs: Runs) -> np.ndarray:
    """Whether each run has its period word by word, and no neighbour extends it."""
    ends = np.append(starts[1:], len(words))
    low, high = starts[runs.owner], ends[runs.owner]
    padded = np.append(words, -1)
    before, after = runs.start - 1, runs.stop
    good = (before < low) | (padded[before] != padded[before + runs.period])
    good &= (after >= high) | (padded[np.minimum(after, len(words))] != padded[after - runs.period])
    lengths = runs.stop - runs.start - runs.period
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
        group, place = ragged(lengths[at:stop])
        one = runs.start[at:stop][group] + place
        wrong = words[one] != words[one + runs.period[at:stop][group]]
        good[at + np.unique(group[wrong])] = False
        at = stop
    return good


def find_runs(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """(start, stop, period) of all runs of each document, by start, then period."""
    lengths = np.array([len(x) for x in documents], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    full = np.flatnonzero(lengths)
    if not len(full):
        return out
    words = np.concatenate([documents[i] for i in full]).astype(np.int64)
    starts = np.cumsum(lengths[full]) - lengths[full]
    grammar = Grammar(words, starts)
    found = merged(translated(grammar, boundary_runs(words, Prefixes(words), grammar), starts))
    good = holds(words, starts, found)
    again = set(found.owner[~good].tolist())
    begin = starts[found.owner]
    rows = zip(
        found.owner.tolist(),
        (found.start - begin).tolist(),
        (found.stop - begin).tolist(),
        found.period.tolist(),
        strict=True,
    )
    for doc, start, stop, period in rows:
        out[full[doc]].append((start, stop, period))
    for doc in again:
        out[full[doc]] = direct(documents[full[doc]])
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, each run cut down to its first period."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, stop, period in runs:
            gone[start + period] += 1
            gone[stop] -= 1
        words = [word for word, n in zip(words, np.cumsum(gone).tolist(), strict=False) if not n]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, text_col: str = "text", change: Change | None = None) -> DataFrame:
    """``docs`` with the periodic runs of words of each whole text.

    ``runs`` is an array of (start, length, period), by start, then period;
    ``collapsed`` is the text with every run cut down to its first period, words
    joined by one blank; ``runs_sha256`` and ``collapsed_sha256`` are digests of both.
    Input columns of these names are replaced. ``change`` may rewrite the words of a
    row before; it gets them and the row's other columns.

    Words are what ASCII white space separates. Null and empty texts have no words, no
    runs and an empty collapsed text; rows that repeat are treated alike, and an empty
    table gives an empty one. One narrow pass: nothing is shuffled, and a task
    holds one block of whole texts at a time, the longest text at least.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, text_col):
                yield _block(block, text_col, change)

    kinds = {
        "runs": "array<struct<start:bigint,length:bigint,period:bigint>>",
        "runs_sha256": "string",
        "collapsed": "string",
        "collapsed_sha256": "string",
    }
    return docs.mapInArrow(run, schema_with(docs, **kinds))


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _block(block: pa.RecordBatch, text_col: str, change: Change | None) -> pa.RecordBatch:
    # bytes.split() splits at the six white space characters of ASCII
    words = [(text or "").encode("utf-8", "replace").split() for text in block.column(text_col).to_pylist()]
    if change is not None:
        others = block.drop_columns([text_col]).to_pylist()
        words = [change(own, row) for own, row in zip(words, others, strict=True)]
    flat = pa.array([word for own in words for word in own], pa.binary()).dictionary_encode()
    ids = np.asarray(flat.indices)
    cuts = np.cumsum([0, *map(len, words)])
    found = find_runs([ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    texts = [collapsed(own, runs) for own, runs in zip(words, found, strict=True)]
    listed = ["".join(f"{a},{b - a},{p}\n" for a, b, p in runs) for runs in found]
    rows = [[{"start": a, "length": b - a, "period": p} for a, b, p in runs] for runs in found]
    return put(
        block,
        {
            "runs": pa.array(rows, _RUN),
            "runs_sha256": pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]),
            "collapsed": pa.array(texts, pa.binary()).cast(pa.string()),
            "collapsed_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
        },
    )

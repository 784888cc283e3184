"""Toxicity: a learned lexicon, matched with spelling errors and judged in its context.

1. Terms and stems that mark toxic documents are learned from labelled rows and
   laid out as a trie.
2. Every distinct word of a block of texts runs a Levenshtein automaton over that trie, so
   misspelled terms are found without listing their variants. All words take the step
   to a node of the trie together; those whose automaton has no state left stay behind.
3. A window of words around each hit separates quotation (quote marks, verbs of
   saying, warnings about a word) from abuse (address in the second person, other
   hits nearby). A logistic model of these counts gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import held_out, put, sample_rows, schema_with, text_blocks

TRAIN_ROWS = 8_000
"""Labelled rows that a model is learned from, about; all of them if there are fewer."""
LONGEST_STEM = 40
"""Letters of a front of a word that may become a term; longer words become terms whole."""
MIN_DOCS = 4
MIN_SHARE = 0.02
MIN_LOG_ODDS = 3.0
WINDOW = 8
FEATURES = 8
MOST_EDITS = 2
TOGETHER = 1 << 16
"""Words that run through the trie at a time."""
_FAR = 100

_WORD = re.compile(r"[^\W_]+")
# Small cue lists for the window.
SAYING = frozenset(
    "said says called wrote word term quote quoted reported phrase slur dit mot sagte wort dijo palabra".split()
)
ADDRESS = frozenset("you your youre u ur du dich dein tu te ton tes vous votre usted tus".split())
QUOTES = "\"“”„«»‘’`"


Hit = tuple[str, float, int]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def allowed_edits(length: int) -> int:
    """Short terms must match exactly; longer ones may be off by one or two edits."""
    return 0 if length < 5 else 1 if length < 9 else MOST_EDITS


@dataclass
class Lexicon:
    """A trie of terms with weights; ``stem`` terms match the front of a word.

    ``find_all`` walks the trie with the states of a Levenshtein automaton for each word:
    after a front of a term, the fewest edits that turn it into each front of the word of
    nearly the same length. A branch is left by the words that have no state within the
    edits that terms below it allow.
    """

    terms: dict[str, tuple[float, bool]]
    root: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        for term, (_, stem) in self.terms.items():
            node = self.root
            for letter in term:
                node = node.setdefault(letter, {})
            node[""] = (term, stem)
        self._depths(self.root, 0)
        # of terms with as many edits the heaviest is taken, then the first
        order = sorted(self.terms, key=lambda term: (-self.terms[term][0], term))
        self.order = order
        self.rank = {term: n for n, term in enumerate(order)}

    def _depths(self, node: dict, depth: int) -> int:
        """Notes the most edits any term below a node allows."""
        most = allowed_edits(depth) if "" in node else 0
        for letter, child in node.items():
            if len(letter) == 1:
                most = max(most, self._depths(child, depth + 1))
        node["edits"] = most
        return most

    def find(self, word: str) -> Hit | None:
        """(term, weight, edits) of the closest, then heaviest term in ``word``, or None."""
        return self.find_all([word]).get(word)

    def find_all(self, words: list[str]) -> dict[str, Hit]:
        """The hits of those words that have one."""
        found: dict[str, Hit] = {}
        for begin in range(0, len(words) if self.terms else 0, TOGETHER):
            part = words[begin : begin + TOGETHER]
            best = self._best(part)
            for i in np.flatnonzero(best < _FAR * len(self.order)).tolist():
                edits, rank = divmod(int(best[i]), len(self.order))
                term = self.order[rank]
                found[part[i]] = (term, self.terms[term][0], edits)
        return found

    def _best(self, words: list[str]) -> np.ndarray:
        """Edits times the number of terms, plus the rank of the term, of each word's best."""
        k, n = MOST_EDITS, len(self.order)
        # only these letters of a word can meet a term
        width = max(map(len, self.order)) + 2 * k + 1
        sizes = np.array([len(word) for word in words])
        codes = np.array([word[:width] for word in words], f"<U{width}").view(np.uint32).reshape(len(words), width)
        best = np.full(len(words), _FAR * n)
        # column c of the states: c - k more letters of the word are used than of the term
        offset = np.arange(-k, k + 1)
        first = np.where((offset >= 0) & (offset <= sizes[:, None]), offset, _FAR).astype(np.int8)
        todo = [(self.root, 0, np.arange(len(words)), first)]
        while todo:
            node, depth, rows, states = todo.pop()
            if "" in node:
                term, stem = node[""]
                if stem:
                    edits = states.min(1)
                else:
                    column = sizes[rows] - depth + k
                    near = (column >= 0) & (column <= 2 * k)
                    edits = np.where(near, states[np.arange(len(rows)), np.clip(column, 0, 2 * k)], _FAR)
                hits = np.flatnonzero(edits <= allowed_edits(depth))
                best[rows[hits]] = np.minimum(best[rows[hits]], edits[hits].astype(np.int64) * n + self.rank[term])
            if len(node) == 1 + ("" in node):
                continue
            used = depth + offset
            inside = (used >= 0) & (used < sizes[rows, None])
            letters = np.where(inside, codes[rows][:, np.clip(used, 0, width - 1)], 0)
            for letter, child in node.items():
                if len(letter) != 1:
                    continue
                after = np.where(inside, states + (letters != ord(letter)), _FAR).astype(np.int8)
                np.minimum(after[:, :-1], states[:, 1:] + 1, out=after[:, :-1])
                for column in range(1, 2 * k + 1):
                    more = np.where(depth + 1 + offset[column] <= sizes[rows], after[:, column - 1] + 1, _FAR)
                    np.minimum(after[:, column], more, out=after[:, column], casting="unsafe")
                np.minimum(after, _FAR, out=after)
                alive = np.flatnonzero(after.min(1) <= child["edits"])
                if len(alive):
                    todo.append((child, depth + 1, rows[alive], after[alive]))
        return best


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.mean) / self.scale @ self.weights[1:] + self.weights[0], -30, 30)
        return 1 / (1 + np.exp(-z))


def fronts_of(text: str) -> set[str]:
    """Words, closed by a mark, and fronts of words."""
    fronts = set()
    for word in set(words_of(text)):
        fronts.add(word + "$")
        fronts.update(word[:n] for n in range(1, min(LONGEST_STEM, len(word)) + 1))
    return fronts


def _front_counts(known: frozenset[str] | None = None):
    """Documents that hold a front, summed per task; of ``known`` ones only, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_pydict(
                {"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())}
            )
            counts.clear()
            return rows

        for batch in batches:
            for text in batch.column("text").to_pylist():
                fronts = fronts_of(text or "")
                counts.update(fronts if known is None else fronts & known)
                if len(counts) > 400_000:
                    yield flush()
        if counts:
            yield flush()

    return run


def least_docs(toxic: int) -> int:
    """Toxic documents that a term must be in: one in a hundred, and a few at least."""
    return max(MIN_DOCS, round(MIN_SHARE * toxic))


def learn_terms(counts: list[tuple[str, int, int]], clean: int, toxic: int) -> dict[str, tuple[float, bool]]:
    """The lexicon from (term, clean documents, toxic documents).

    Of a chain of fronts the longest is taken that still covers nearly all the
    documents of the shortest one; it is a whole word if it mostly ends there.
    """
    odds = {}
    ends = Counter()
    for term, c, t in counts:
        if term.endswith("$"):
            ends[term[:-1]] = t
            if len(term) - 1 <= LONGEST_STEM:
                continue
            term = term[:-1]
        weight = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if t >= least_docs(toxic) and weight >= MIN_LOG_ODDS and c <= 0.1 * t:
            odds[term] = (t, weight)
    children: dict[str, list[str]] = {}
    for term in odds:
        children.setdefault(term[:-1], []).append(term)
    chosen = {}
    for term in sorted(odds):
        if term[:-1] in odds:
            continue
        covered = odds[term][0]
        while longer := [x for x in children.get(term, ()) if odds[x][0] >= 0.95 * covered]:
            term = max(longer, key=lambda x: odds[x][0])
        chosen[term] = (odds[term][1], ends[term] < 0.8 * odds[term][0])
    return {term: (weight, stem) for term, (weight, stem) in chosen.items()}


def quoted(text: str, start: int, end: int) -> bool:
    """Whether quote marks stand close on both sides."""
    return any(c in QUOTES for c in text[max(0, start - 24) : start]) and any(
        c in QUOTES for c in text[end : end + 24]
    )


def measured(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """The features of texts, a row for each; every distinct word is looked up once."""
    lowered = [text.lower() for text in texts]
    chunks: set[str] = set()
    for text in lowered:
        chunks.update(text.split())
    words = {chunk: _WORD.findall(chunk) for chunk in chunks}
    hits = lexicon.find_all(sorted({word for own in words.values() for word in own}))
    marked = {chunk for chunk, own in words.items() if not hits.keys().isdisjoint(own)}
    rows = [
        measure(text, hits) if not marked.isdisjoint(text.split()) else [0.0] * FEATURES
        for text in lowered
    ]
    return np.array(rows).reshape(-1, FEATURES)


def measure(text: str, hits: dict[str, Hit]) -> list[float]:
    """The features of one lower-case text: hits that abuse and hits that quote, by exactness.

    Each hit weighs in with its log odds. A hit is a quotation if quote marks stand
    close around it or a verb of saying stands in its window, unless the window also
    addresses the reader.
    """
    spans = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(text)]
    places = [i for i, span in enumerate(spans) if span[2] in hits]
    abuse = [0.0, 0.0]
    quote = [0.0, 0.0]
    abused: list[str] = []
    address = clustered = 0
    for n, i in enumerate(places):
        start, end, word = spans[i]
        _, weight, edits = hits[word]
        window = {spans[j][2] for j in range(max(0, i - WINDOW), min(len(spans), i + WINDOW + 1))}
        direct = not window.isdisjoint(ADDRESS)
        address += direct
        clustered += n > 0 and i - places[n - 1] <= WINDOW
        told = quoted(text, start, end) or not window.isdisjoint(SAYING)
        if told and not direct:
            quote[edits > 0] += weight
        else:
            abuse[edits > 0] += weight
            abused.append(word)
    return [
        math.log1p(abuse[0]),
        math.log1p(abuse[1]),
        math.log1p(quote[0]),
        math.log1p(quote[1]),
        float(len({hits[word][0] for word in abused})),
        math.log1p(1000 * len(abused) / len(spans)),
        math.log1p(address),
        math.log1p(clustered),
    ]


def _measured(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch):
                rows = measured([text or "" for text in block.column("text").to_pylist()], lexicon)
                yield pa.RecordBatch.from_pydict(
                    {"features": pa.array(rows.tolist(), pa.list_(pa.float64())), "toxic": block.column("toxic")}
                )

    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple:
    """Ridge logistic regression by Newton steps; (weights, mean, scale).

    More hits never make a text less toxic: features whose weight would be negative
    are left out, and the rest fitted again.
    """
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    used = np.ones(z.shape[1], bool)
    while True:
        w = newton(z[:, used], y, ridge)
        negative = np.flatnonzero(used)[1:][w[1:] < 0]
        if not len(negative):
            weights = np.zeros(z.shape[1])
            weights[used] = w
            return weights, mean, scale
        used[negative] = False


def newton(z: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-9
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (p - y) / len(y) + penalty * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(penalty + 1e-9)
        move = np.linalg.solve(hessian, gradient)
        w -= move / max(1.0, np.abs(move).max())
        if np.abs(move).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learns lexicon and weights from labelled rows outside the held-out fifth.

    ``train_rows`` bounds the sample; texts that repeat count once, so that a group
    of copies cannot turn its own words into terms. Without both classes, or without
    a term that tells them apart, every score is the share of toxic labels, at most
    0.49: nothing speaks against any document.
    """
    marks = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    marks = sample_rows(marks, F.col("doc_id"), train_rows)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(marks), "doc_id")  # bounded by train_rows
        .groupBy(F.xxhash64("text").alias("copy"))
        .agg(F.max("toxic").cast("int").alias("toxic"), F.any_value("text").alias("text"))
        .drop("copy")
        .persist()
    )
    sizes = {row["toxic"]: row["count"] for row in rows.groupBy("toxic").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    share = min(0.49, (toxic + 0.5) / (clean + toxic + 1.0))
    none = np.zeros(FEATURES)
    blank = Model(Lexicon({}), np.array([math.log(share / (1 - share)), *none]), none, none + 1)
    if not clean or not toxic:
        rows.unpersist()
        return blank

    def counted(kind: int, known: frozenset[str] | None, least: int) -> dict[str, int]:
        part = rows.where(F.col("toxic") == kind).select("text")
        sums = part.mapInArrow(_front_counts(known), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
        return {row["term"]: row["n"] for row in sums.where(F.col("n") >= least).collect()}

    bad = counted(1, None, least_docs(toxic))
    good = counted(0, frozenset(bad), 1)
    counts = [(term, good.get(term, 0), n) for term, n in bad.items()]
    terms = learn_terms(counts, clean, toxic)
    if not terms:
        rows.unpersist()
        return blank
    lexicon = Lexicon(terms)
    table = rows.mapInArrow(_measured(lexicon), "features array<double>, toxic int").collect()
    rows.unpersist()
    x = np.array([row["features"] for row in table])
    y = np.array([row["toxic"] for row in table], dtype=float)
    return Model(lexicon, *fit_logistic(x, y))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxic_score") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1) appended; one narrow pass over whole texts.

    An input column of that name is replaced. Null and empty texts have no hits and get
    the score of such a text; a text's score depends on nothing but the text, so rows that
    repeat get the same, and an empty table gives an empty one. Words are looked up
    block by block; nothing is kept from one block to the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, text_col):
                texts = [text or "" for text in block.column(text_col).to_pylist()]
                found = model.scores(measured(texts, model.lexicon))
                yield put(block, {score_col: pa.array(found, pa.float64())})

    return docs.mapInArrow(run, schema_with(docs, **{score_col: "double"}))

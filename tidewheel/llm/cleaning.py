"""Quality rules, line first: bad lines go, then documents that lose too much of their text.

Every line with a word is judged on its own by three kinds of rules. A line is removed if
it is navigation entries or boilerplate, or if it ends no sentence and holds the end of none. What is left is the
cleaned text; a document that keeps too small a share of its words, or too few of them,
is rejected. Counts over the whole document (symbols, repeated lines, repeated windows
of words) come from the same pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewheel.llm.common import put, schema_with, text_blocks

# The symbols that are counted, and the cues of the line rules.
SYMBOLS = "#*$%&|<>"
ENDS = ".!?:;…"
CLOSERS = "\"'”’»)]}*_"
SEPARATORS = "|›»•·"
CUES = (
    "cookie", "javascript", "privacy policy", "terms of use", "terms of service", "all rights reserved",
    "lorem ipsum", "sign in", "log in", "subscribe", "click here", "read more", "share this", "skip to content",
)


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; all counts are of one line unless a name says otherwise."""

    separators: int = 2
    """A line with so many separators, and one for every four words, is navigation."""
    cue_words: int = 20
    """A line of at most so many words with a cue is boilerplate, and so is a repeated line."""
    capitals: int = 20
    """A line with so many capitals, and fewer small letters (ASCII), is boilerplate."""
    least_kept: int = 70
    """Percent of its words that a document keeps, at least."""
    document_words: int = 10
    window: int = 5
    repeated: int = 20
    """Percent of the document's words in windows found twice, at most."""


_SEPARATED = re.compile(f"[{re.escape(SEPARATORS)}]")
_CUE = re.compile("|".join(map(re.escape, CUES)))
_SENTENCE = re.compile(r"[.!?…][\x20\x09-\x0D]")
_SPACES = " \t\n\r\x0b\f"
_NOT_CAPITAL = bytes(b for b in range(256) if not 65 <= b <= 90)
_NOT_SMALL = bytes(b for b in range(256) if not 97 <= b <= 122)


def line_fault(line: str, words: int, seen: bool, rules: Rules) -> str | None:
    """The first rule that a line with ``words`` words fails, or None; ``seen`` tells that
    an equal line came before."""
    separators = len(_SEPARATED.findall(line))
    if separators >= rules.separators and 4 * separators >= words:
        return "navigation"
    raw = line.encode("utf-8", "replace")
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    capitals = len(raw.translate(None, _NOT_CAPITAL))
    if (
        2 * symbols > words
        or (capitals >= rules.capitals and capitals > len(raw.translate(None, _NOT_SMALL)))
        or (words <= rules.cue_words and (seen or _CUE.search(line.lower())))
    ):
        return "boilerplate"
    end = line.rstrip(_SPACES).rstrip(CLOSERS)[-1:]
    if (not end or end not in ENDS) and not _SENTENCE.search(line):
        return "punctuation"
    return None


FAULTS = ("navigation", "boilerplate", "punctuation")


@dataclass
class Cleaned:
    text: str
    kept_words: int
    dup_lines: int
    faults: dict[str, int]


def clean(text: str, rules: Rules) -> Cleaned:
    """``text`` without the lines that fail a rule. Lines without a word stay if the line
    before them does."""
    seen: set[str] = set()
    out, kept_words, dup_lines, stays = [], 0, 0, True
    faults = dict.fromkeys(FAULTS, 0)
    for line in text.split("\n"):
        words = len(line.encode("utf-8", "replace").split())
        if words:
            again = line in seen
            seen.add(line)
            dup_lines += again
            fault = line_fault(line, words, again, rules)
            stays = fault is None
            if stays:
                kept_words += words
            else:
                faults[fault] += 1
        if stays:
            out.append(line)
    return Cleaned("\n".join(out), kept_words, dup_lines, faults)


def repeated_words(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """For each document, how many of its words lie in windows of ``size`` words that it
    holds twice or more, the first one included.

    Windows get exact numbers by pairing: of one word, of two, and so on.
    """
    n = len(ids)
    counts = np.diff(np.append(starts, n))
    doc = np.repeat(np.arange(len(starts)), counts)
    if n < size:
        return np.zeros(len(starts), np.int64)
    last = n - size + 1
    # in ranges of a document: the number of a window, joined with the next word
    window = doc[:last] * (int(ids.max()) + 1) + ids[:last]
    for step in range(1, size):
        _, window = np.unique(window, return_inverse=True)
        window = window * (int(ids.max()) + 1) + ids[step : last + step]
    inside = doc[:last] == doc[size - 1 :]
    _, name, often = np.unique(window[inside], return_inverse=True, return_counts=True)
    edges = np.zeros(n + 1, np.int64)
    found = np.flatnonzero(inside)[often[name] > 1]
    edges[found] += 1
    edges[found + size] -= 1
    covered = np.append(0, np.cumsum(np.cumsum(edges[:-1]) > 0))
    return covered[starts + counts] - covered[starts]


COLUMNS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "n_kept_words": "bigint",
    **{f"n_{fault}_lines": "bigint" for fault in FAULTS},
    "base_failed": "boolean",
    "kept": "boolean",
    "cleaned": "string",
}


def clean_documents(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``docs`` with the columns of ``COLUMNS``: counts over each whole text, lines removed
    by rule, the cleaned text, and the verdict.

    ``base_failed``: fewer than ``document_words`` words, or too many in repeated windows.
    ``kept``: not that, and the cleaned text keeps ``least_kept`` percent of the words. Words are
    what ASCII white space separates; equal lines are equal in every character. Null and
    empty texts have no words and fail; rows that repeat are treated alike; an empty table
    gives an empty one; input columns of these names are replaced. One narrow pass, a
    block of whole texts at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, text_col):
                yield _block(block, text_col, rules)

    return docs.mapInArrow(run, schema_with(docs, **COLUMNS))


def _block(block: pa.RecordBatch, text_col: str, rules: Rules) -> pa.RecordBatch:
    texts = [text or "" for text in block.column(text_col).to_pylist()]
    words = [text.encode("utf-8", "replace").split() for text in texts]
    counts = np.array([len(x) for x in words], np.int64)
    flat = pa.array([word for own in words for word in own], pa.binary()).dictionary_encode()
    repeats = repeated_words(np.asarray(flat.indices, np.int64), np.cumsum(counts) - counts, rules.window)
    cleaned = [clean(text, rules) for text in texts]
    kept = np.array([x.kept_words for x in cleaned], np.int64)
    failed = (counts < rules.document_words) | (100 * repeats > rules.repeated * counts)
    values = {
        "n_words": counts,
        "word_chars": [len(text) - sum(map(text.count, _SPACES)) for text in texts],
        "n_symbols": [sum(map(text.count, SYMBOLS)) for text in texts],
        "n_dup_lines": [x.dup_lines for x in cleaned],
        "n_repeat_words": repeats,
        "n_kept_words": kept,
        **{f"n_{fault}_lines": [x.faults[fault] for x in cleaned] for fault in FAULTS},
    }
    return put(
        block,
        {name: pa.array(column, pa.int64()) for name, column in values.items()}
        | {
            "base_failed": pa.array(failed),
            "kept": pa.array(~failed & (100 * kept >= rules.least_kept * counts)),
            "cleaned": pa.array([x.text for x in cleaned], pa.string()),
        },
    )

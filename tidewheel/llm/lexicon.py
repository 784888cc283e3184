"""A minimal acyclic transducer from words to token ids, laid out for memory mapping.

Words are paths of bytes; equal endings share their states. Every transition puts
out an integer, and the integers along a path sum up to the number of the word,
which points into a table of token ids.
"""

from __future__ import annotations

import mmap
from bisect import bisect_left

import numpy as np

MAGIC = 0x54574C58


class _State:
    __slots__ = ("arcs", "final", "number", "below")

    def __init__(self) -> None:
        self.arcs: list[tuple[int, _State]] = []
        self.final = False
        self.number = -1
        self.below = 0

    def key(self) -> tuple:
        return (self.final, *((label, id(state)) for label, state in self.arcs))


def build(entries: dict[str, list[int]]) -> bytes:
    """The file for ``entries``; words are added in byte order, each state is merged
    with an equal one as soon as no later word can change it."""
    words = sorted((word.encode(), ids) for word, ids in entries.items())
    root = _State()
    merged: dict[tuple, _State] = {}
    path: list[_State] = [root]
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            label = last[len(path) - 1]
            path[-1].arcs[-1] = (label, merged.setdefault(state.key(), state))

    for word, _ in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        for label in word[shared:]:
            state = _State()
            path[-1].arcs.append((label, state))
            path.append(state)
        path[-1].final = True
        last = word
    close(0)
    return _layout(root, [ids for _, ids in words])


def _layout(root: _State, table: list[list[int]]) -> bytes:
    order: list[_State] = []
    todo = [(root, False)]
    while todo:  # children before parents
        state, done = todo.pop()
        if done:
            if state.number < 0:
                state.number = len(order)
                state.below = state.final + sum(child.below for _, child in state.arcs)
                order.append(state)
        elif state.number < 0:
            todo.append((state, True))
            todo.extend((child, False) for _, child in state.arcs)
    first, labels, targets, outputs = [0], [], [], []
    for state in order:
        passed = int(state.final)
        for label, child in state.arcs:
            labels.append(label)
            targets.append(child.number)
            outputs.append(passed)
            passed += child.below
        first.append(len(labels))
    finals = [int(state.final) for state in order]
    starts = np.cumsum([0, *map(len, table)])
    flat = [i for ids in table for i in ids]
    parts = [first, labels, targets, outputs, finals, starts, flat]
    head = [MAGIC, root.number, *map(len, parts)]
    return b"".join(np.asarray(part, "<u4").tobytes() for part in [head, *parts])


class Transducer:
    """Looks words up in a file made by ``build``, through the page cache."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        cells = memoryview(self.map).cast("I")
        head = cells[:9].tolist()
        if head[0] != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.root = head[1]
        at, parts = 9, []
        for length in head[2:]:
            parts.append(cells[at : at + length])
            at += length
        self.first, self.labels, self.targets, self.outputs, self.finals, self.starts, self.ids = parts
        self.states = len(self.finals)

    def find(self, word: str) -> list[int] | None:
        """Token ids of ``word``, or None if it is not in the lexicon."""
        state, number = self.root, 0
        first, labels = self.first, self.labels
        for label in word.encode():
            end = first[state + 1]
            arc = bisect_left(labels, label, first[state], end)
            if arc == end or labels[arc] != label:
                return None
            number += self.outputs[arc]
            state = self.targets[arc]
        if not self.finals[state]:
            return None
        return self.ids[self.starts[number] : self.starts[number + 1]].tolist()

    def find_all(self, letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word in the lexicon, -1 if it is not there; words are
        stretches of ``letters`` (bytes), and all of them take a transition at a time."""
        first, labels, targets, outputs, finals = (
            np.asarray(x) for x in (self.first, self.labels, self.targets, self.outputs, self.finals)
        )
        # arcs lie in order of their state and label
        arcs = np.repeat(np.arange(self.states, dtype=np.int64), np.diff(first.astype(np.int64))) << 8 | labels
        number = np.full(len(starts), -1, np.int64)
        if not len(arcs):
            return number
        rows, states, passed = np.arange(len(starts)), np.full(len(starts), self.root, np.int64), np.zeros(len(starts), np.int64)
        depth = 0
        while len(rows):
            done = sizes[rows] == depth
            ends = done & (finals[states] > 0)
            number[rows[ends]] = passed[ends]
            rows, states, passed = rows[~done], states[~done], passed[~done]
            key = states << 8 | letters[starts[rows] + depth]
            arc = np.minimum(np.searchsorted(arcs, key), len(arcs) - 1)
            on = arcs[arc] == key
            rows, arc = rows[on], arc[on]
            states, passed = targets[arc].astype(np.int64), passed[on] + outputs[arc]
            depth += 1
        return number

"""Weighted acyclic automata over words: count transducers of phrases.

A phrase is a path of arcs from the root, an arc reads one word (a number into
``labels``, which are sorted) and its weight is the count of the phrase that
ends on it (0: none does).  States with the same arcs are one state.  Arcs are
kept by state and word, so an arc is found by binary search and whole frontiers
are walked at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from brisa.llm.common import group_starts, mix

#: Words of the longest phrase.
WORDS = 4


@dataclass
class Automaton:
    labels: list  # bytes, ascending
    first: np.ndarray  # first arc of each state, and the number of arcs; the root is the last state, state 0 has no arcs
    label: np.ndarray
    target: np.ndarray
    weight: np.ndarray

    def arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``states``, arc) of all arcs that leave the states."""
        n = self.first[states + 1] - self.first[states]
        row = np.repeat(np.arange(len(states)), n)
        return row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[states][row]

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, -1 after the last word; counts) of all phrases, shorter ones first."""
        states, path = np.array([len(self.first) - 2]), np.zeros((1, 0), np.int32)
        out, counts = [np.zeros((0, WORDS), np.int32)], [np.zeros(0, np.int64)]
        while len(states):
            row, arc = self.arcs(states)
            path = np.concatenate([path[row], self.label[arc, None]], axis=1)
            ends = self.weight[arc] > 0
            out.append(np.pad(path[ends], ((0, 0), (0, WORDS - path.shape[1])), constant_values=-1))
            counts.append(self.weight[arc][ends])
            states = self.target[arc]
            more = states > 0
            states, path = states[more], path[more]
        return np.concatenate(out), np.concatenate(counts)

    def compose(self, asked: Automaton) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of ``asked``, counts here) of the phrases of ``asked`` that are phrases here too."""
        here = {w: i for i, w in enumerate(self.labels)}
        same = np.array([here.get(w, -1) for w in asked.labels], np.int64)
        key = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) << 32 | self.label
        p, q, path = np.array([len(asked.first) - 2]), np.array([len(self.first) - 2]), np.zeros((1, 0), np.int32)
        out, counts = [np.zeros((0, WORDS), np.int32)], [np.zeros(0, np.int64)]
        while len(p):
            row, arc = asked.arcs(p)
            word = same[asked.label[arc]]
            want = q[row] << 32 | np.maximum(word, 0)
            at = np.minimum(np.searchsorted(key, want), max(len(key) - 1, 0))
            met = (word >= 0) & (key[at] == want) if len(key) else np.zeros(len(arc), bool)
            row, arc, at = row[met], arc[met], at[met]
            path = np.concatenate([path[row], asked.label[arc, None]], axis=1)
            ends = (asked.weight[arc] > 0) & (self.weight[at] > 0)
            out.append(np.pad(path[ends], ((0, 0), (0, WORDS - path.shape[1])), constant_values=-1))
            counts.append(self.weight[at][ends])
            p, q = asked.target[arc], self.target[at]
            more = (p > 0) & (q > 0)
            p, q, path = p[more], q[more], path[more]
        return np.concatenate(out), np.concatenate(counts)

    def pack(self) -> bytes:
        ends = np.cumsum([len(w) for w in self.labels], dtype=np.int64)
        head = np.array([len(self.first), len(self.label), len(self.labels)], np.int64)
        wide = np.uint32 if self.weight.max(initial=0) < 1 << 32 else np.uint64
        parts = [head, np.array([np.dtype(wide).itemsize], np.int64), self.first.astype(np.uint32), self.label.astype(np.uint32), self.target.astype(np.uint32), self.weight.astype(wide), ends.astype(np.uint32)]
        return b"".join([*(p.tobytes() for p in parts), *self.labels])

    @staticmethod
    def unpack(raw: bytes) -> Automaton:
        states, arcs, words, wide = np.frombuffer(raw, np.int64, 4).tolist()
        at, out = 32, []
        for n, kind in ((states, np.uint32), (arcs, np.uint32), (arcs, np.uint32), (arcs, np.uint32 if wide == 4 else np.uint64), (words, np.uint32)):
            out.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        ends = [0, *out[4].tolist()]
        labels = [raw[at + a:at + b] for a, b in zip(ends, ends[1:])]
        return Automaton(labels, out[0].astype(np.int64), out[1].astype(np.int32), out[2].astype(np.int64), out[3].astype(np.int64))


class Builder:
    """Builds an automaton from phrases in order, a batch at a time.

    A batch holds every phrase of its first words, so the states below a first word are complete when
    its batch has been added: they are looked up among those known and only new ones are kept.
    """

    def __init__(self, labels: list):
        self.labels, self.known = labels, {}
        self.sizes, self.label, self.target, self.weight = [np.zeros(1, np.int64)], [], [], []
        self.states = 1
        self.top: list = []

    def _freeze(self, starts: np.ndarray, label: np.ndarray, target: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """State numbers of groups of arcs (``starts`` has one more entry)."""
        h = mix(label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(target.astype(np.uint64) + np.uint64(1)) + mix(weight.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)))
        two = np.stack([np.add.reduceat(mix(h + np.uint64(k)), starts[:-1]) + np.diff(starts).astype(np.uint64) for k in (1, 2)], axis=1)
        two = np.ascontiguousarray(two).view([("a", np.uint64), ("b", np.uint64)]).ravel()
        names, at, inverse = np.unique(two, return_index=True, return_inverse=True)
        number = np.empty(len(names), np.int64)
        new = []
        for i, name in enumerate(names.tolist()):
            have = self.known.get(name)
            if have is None:
                have = self.known[name] = self.states
                self.states += 1
                new.append(i)
            number[i] = have
        if new:
            group = at[new]
            n = np.diff(starts)[group]
            arc = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[:-1][group], n)
            self.sizes.append(n)
            for mine, values in ((self.label, label), (self.target, target), (self.weight, weight)):
                mine.append(values[arc])
        return number[inverse.ravel()]

    def add(self, paths: np.ndarray, weights: np.ndarray) -> None:
        """Phrases (word numbers, -1 after the last) in ascending order, later than all before, none twice."""
        if not len(paths):
            return
        new = np.ones(len(paths), bool)
        below: tuple | None = None
        levels = []
        changed = np.zeros(len(paths), bool)
        changed[0] = True
        for d in range(WORDS):
            changed[1:] |= paths[1:, d] != paths[:-1, d]
            new = changed & (paths[:, d] >= 0)
            levels.append(np.flatnonzero(new))
        size = (paths >= 0).sum(axis=1)
        for d in range(WORDS - 1, -1, -1):
            rows = levels[d]
            label, weight = paths[rows, d], np.where(size[rows] == d + 1, weights[rows], 0)
            target = np.zeros(len(rows), np.int64)
            if below is not None and len(below[0]):
                target[np.searchsorted(rows, below[0], side="right") - 1] = below[1]
            if d == 0:
                self.top.append((label, target, weight))
            elif len(rows):
                parent = np.searchsorted(levels[d - 1], rows, side="right") - 1
                starts = group_starts(parent)
                below = rows[starts[:-1]], self._freeze(starts, label, target, weight)

    def finish(self) -> Automaton:
        label, target, weight = (np.concatenate(c) for c in zip(*self.top)) if self.top else (np.zeros(0, np.int64),) * 3
        sizes = np.concatenate([*self.sizes, [len(label)]])
        whole = lambda kept, last, kind: np.concatenate([*kept, last]).astype(kind)
        return Automaton(self.labels, np.concatenate([[0], np.cumsum(sizes)]), whole(self.label, label, np.int32), whole(self.target, target, np.int64), whole(self.weight, weight, np.int64))


def build(labels: list, paths: np.ndarray, weights: np.ndarray, batch: int = 1 << 17) -> Automaton:
    """An automaton of phrases in ascending order; words that no phrase has are left out of its labels."""
    used = np.unique(paths)
    used = used[used >= 0]
    number = np.full(len(labels) + 1, -1, np.int32)
    number[used] = np.arange(len(used))
    paths = number[paths]
    out = Builder([labels[i] for i in used.tolist()])
    lo = 0
    while lo < len(paths):
        hi = min(lo + batch, len(paths))
        while hi < len(paths) and paths[hi, 0] == paths[hi - 1, 0]:
            hi = min(hi + batch, int(np.searchsorted(paths[:, 0], paths[hi, 0], side="right")))
        out.add(paths[lo:hi], weights[lo:hi])
        lo = hi
    return out.finish()


def ordered(paths: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases in ascending order, equal ones once with the sum of their weights."""
    if not len(paths):
        return paths, weights
    order = np.lexsort(paths.T[::-1])
    paths, weights = paths[order], weights[order]
    starts = group_starts(*paths.T)
    return paths[starts[:-1]], np.add.reduceat(weights, starts[:-1])


def union(parts: list) -> tuple[list, np.ndarray, np.ndarray]:
    """(labels, word numbers, counts) of the phrases of (labels, word numbers, counts) parts, counts summed."""
    labels = sorted(set().union(*(p[0] for p in parts)))
    number = {w: i for i, w in enumerate(labels)}
    moved = []
    for mine, paths, _ in parts:
        to = np.array([*(number[w] for w in mine), -1], np.int32)  # -1 stays -1
        moved.append(to[paths])
    return (labels, *ordered(np.concatenate(moved), np.concatenate([p[2] for p in parts])))

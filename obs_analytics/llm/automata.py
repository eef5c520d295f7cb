"""Weighted acyclic automata over word hashes: count transducers of phrases.

A transducer maps phrases (sequences of 64-bit labels) to counts. It is
deterministic; the count of a phrase is the weight of the last arc of its path,
0 for phrases that are only beginnings of others. States with equal arcs (label,
weight, target) are one state, so common endings are stored once. Phrases are
rows of a matrix whose unused places are 0. State 0 has no arcs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from obs_analytics.llm import arrays

U64 = np.uint64


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def _planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane (high planes are mostly zeros, which the
    shuffle's compression removes)."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _from_planes(data: bytes, n: int, size: int, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).view(f"<u{size}").ravel()


@dataclass
class Transducer:
    """Arcs of state s: ``first[s]:first[s + 1]``, sorted by label."""

    root: int
    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray

    def to_bytes(self, known: np.ndarray = np.zeros(0, U64)) -> bytes:
        """Labels once each, arcs by the gap to the number of their label from the
        arc before, every list in the narrowest integers that hold it. ``known``
        are labels that the reader has from elsewhere and that are not written."""
        labels, number = np.unique(self.label, return_inverse=True)
        number = _narrow(number)
        gaps = number.copy()
        gaps[1:] -= number[:-1]  # modulo the integers' size
        lists = [_narrow(np.diff(self.first)), gaps, _narrow(self.weight), _narrow(self.target)]
        rest = labels[~np.isin(labels, known, assume_unique=True)]
        head = np.array([self.root, len(self.first) - 1, len(self.label), len(rest), *(x.itemsize for x in lists)], np.int64)
        return b"".join([head.tobytes(), rest.tobytes(), *map(_planes, lists)])

    @staticmethod
    def from_bytes(data: bytes, known: np.ndarray = np.zeros(0, U64)) -> Transducer:
        root, states, arcs, rest, *sizes = np.frombuffer(data, np.int64, 8).tolist()
        labels = np.sort(np.concatenate([known, np.frombuffer(data, U64, rest, 64)]))
        at, parts = 64 + 8 * rest, []
        for n, size in zip((states, arcs, arcs, arcs), sizes, strict=True):
            parts.append(_from_planes(data, n, size, at))
            at += n * size
        degree, gaps, weight, target = parts
        number = np.cumsum(gaps, dtype=gaps.dtype)
        return Transducer(root, np.concatenate([[0], np.cumsum(degree, dtype=np.int64)]), labels[number], weight.astype(np.int64), target.astype(np.int64))

    def compose(self, phrases: np.ndarray) -> np.ndarray:
        """Counts of the given phrases: the transducer composed with their paths."""
        state, count = np.full(len(phrases), self.root), np.zeros(len(phrases), np.int64)
        for labels in phrases.T:
            on = np.flatnonzero(labels)
            low, end = self.first[state[on]], self.first[state[on] + 1]
            high = end.copy()
            while (open_ := low < high).any():  # first arc whose label is not below
                middle = (low + high) // 2
                below = open_ & (self.label[np.minimum(middle, len(self.label) - 1)] < labels[on])
                low, high = np.where(below, middle + 1, low), np.where(open_ & ~below, middle, high)
            hit = low < end
            hit[hit] = self.label[low[hit]] == labels[on[hit]]
            count[on] = 0
            count[on[hit]] = self.weight[low[hit]]
            state[on] = 0
            state[on[hit]] = self.target[low[hit]]
        return count


class Builder:
    """Builds a transducer from runs of sorted phrases. Runs come in ascending
    order and share no first label, so the states of a run are final when it has
    been added; only the arcs of the root wait for the end."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.sizes, self.arcs = [np.zeros(1, np.int64)], [[], [], []]
        self.known = np.zeros(0, [("x", U64), ("y", U64)])
        self.known_state = np.zeros(0, np.int64)
        self.n_states = 1
        self.root: list[list[np.ndarray]] = [[], [], []]

    def add(self, phrases: np.ndarray, weights: np.ndarray) -> None:
        """Distinct phrases in ascending order of their labels, and their counts."""
        if len(phrases) == 0:
            return
        length = (phrases != 0).sum(1)
        new = np.ones(len(phrases), bool)
        starts = []  # rows with a new beginning of each length
        same = np.ones(len(phrases) - 1, bool)
        for level in range(self.width):
            same = same & (phrases[1:, level] == phrases[:-1, level])
            new[1:] = ~same
            starts.append(np.flatnonzero(new & (phrases[:, level] != 0)))
        below = np.zeros(0, np.int64), np.zeros(0, np.int64)  # (row, state) of the states one level down
        for level in reversed(range(self.width)):
            rows = starts[level]
            label = phrases[rows, level]
            weight = np.where(length[rows] == level + 1, weights[rows], 0)
            target = np.zeros(len(rows), np.int64)
            if len(below[0]):  # a state belongs to the last arc that starts at or before it
                target[np.searchsorted(rows, below[0], "right") - 1] = below[1]
            if level == 0:
                for kept, found in zip(self.root, (label, weight, target), strict=True):
                    kept.append(found)
            elif len(rows):
                parent = np.searchsorted(starts[level - 1], rows, "right")
                edge = np.flatnonzero(np.diff(parent, prepend=-1))
                below = rows[edge], self._states(edge, label, weight, target)
            else:
                below = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _states(self, edge: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The state of each group of arcs: a known one with equal arcs or a new one."""
        size = np.diff(np.append(edge, len(label)))
        sign = np.zeros(len(edge), self.known.dtype)
        for name, salt in (("x", 1), ("y", 2)):
            arc = arrays.mixed(label ^ arrays.mixed(weight.view(U64) * U64(2 * salt + 1) ^ arrays.mixed(target.view(U64) + U64(salt))))
            sign[name] = np.add.reduceat(arc, edge)
        found, at, back = np.unique(sign, return_index=True, return_inverse=True)
        state = np.full(len(found), -1)
        if len(self.known):
            place = np.minimum(np.searchsorted(self.known, found), len(self.known) - 1)
            old = self.known[place] == found
            state[old] = self.known_state[place[old]]
        fresh = np.flatnonzero(state < 0)
        state[fresh] = self.n_states + np.arange(len(fresh))
        self.n_states += len(fresh)
        begin, count = edge[at[fresh]], size[at[fresh]]
        taken = np.repeat(begin, count) + arrays.ramp(count)
        self.sizes.append(count)
        for kept, values in zip(self.arcs, (label, weight, target), strict=True):
            kept.append(values[taken])
        order = np.argsort(known := np.concatenate([self.known, found[fresh]]))
        self.known, self.known_state = known[order], np.concatenate([self.known_state, state[fresh]])[order]
        return state[back]

    def finish(self) -> Transducer:
        none = (np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        label, weight, target = (np.concatenate([z, *inner, *top]) for z, inner, top in zip(none, self.arcs, self.root, strict=True))
        sizes = np.concatenate([*self.sizes, [sum(map(len, self.root[0]))]])
        return Transducer(self.n_states, np.concatenate([[0], np.cumsum(sizes)]), label, weight, target)


def ascending(phrases: np.ndarray) -> np.ndarray:
    """Order of the rows by their labels."""
    return np.lexsort(phrases.T[::-1])


def summed(phrases: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct phrases in ascending order and their added weights."""
    order = ascending(phrases)
    phrases, weights = phrases[order], weights[order]
    new = np.ones(len(phrases), bool)
    new[1:] = (phrases[1:] != phrases[:-1]).any(1)
    start = np.flatnonzero(new)
    return phrases[start], np.add.reduceat(weights, start) if len(start) else weights


def build(phrases: np.ndarray, weights: np.ndarray) -> Transducer:
    """The transducer of distinct phrases in ascending order."""
    made = Builder(phrases.shape[1])
    made.add(phrases, weights)
    return made.finish()


def union(parts: list[Transducer], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of all parts in ascending order, with the sums of their
    counts: from the roots on, arcs of equal label that leave one united state
    become one arc, their weights added and their targets united."""
    shift = np.cumsum([0, *(len(p.first) for p in parts)])
    arc_shift = np.cumsum([0, *(len(p.label) for p in parts)])
    first = np.concatenate([p.first + a for p, a in zip(parts, arc_shift, strict=False)])
    label, weight = (np.concatenate([getattr(p, name) for p in parts]) for name in ("label", "weight"))
    target = np.concatenate([p.target + s for p, s in zip(parts, shift, strict=False)])
    united = np.zeros((1, width), U64)  # the phrase that leads to each united state
    member, owner = np.array([p.root + s for p, s in zip(parts, shift, strict=False)]), np.zeros(len(parts), np.int64)
    found, counts = [], []
    for level in range(width):
        degree = first[member + 1] - first[member]
        arc = np.repeat(first[member], degree) + arrays.ramp(degree)
        own = np.repeat(owner, degree)
        order = np.lexsort((label[arc], own))
        arc, own = arc[order], own[order]
        new = np.ones(len(arc), bool)
        new[1:] = (own[1:] != own[:-1]) | (label[arc[1:]] != label[arc[:-1]])
        start = np.flatnonzero(new)
        if len(start) == 0:
            break
        united = united[own[start]]
        united[:, level] = label[arc[start]]
        total = np.add.reduceat(weight[arc], start)
        found.append(united[total > 0])
        counts.append(total[total > 0])
        member, owner = target[arc], np.cumsum(new) - 1
    if not found:
        return np.zeros((0, width), U64), np.zeros(0, np.int64)
    phrases, counts = np.concatenate(found), np.concatenate(counts)
    order = ascending(phrases)
    return phrases[order], counts[order]

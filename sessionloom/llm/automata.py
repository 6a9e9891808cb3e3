"""Weighted acyclic automata over phrases of numbered words, as arrays.

An automaton maps phrases to counts: the weight of the last arc of a phrase is its count, 0 where
the phrase is only the beginning of others. Equal states (same labels, weights and targets) are
one state, so equal endings are stored once as equal beginnings are.

Phrases are rows of a matrix of positive word numbers, padded with 0 at the right.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

from sessionloom.llm.textscan import mixed

_ODD = np.uint64(0x9E3779B97F4A7C15)


def in_order(phrases: np.ndarray) -> np.ndarray:
    """Order of the rows, a beginning before what it begins."""
    bits = int(phrases.max(initial=0)).bit_length()
    if bits * phrases.shape[1] > 63:
        return np.lexsort(phrases.T[::-1])
    key = np.zeros(len(phrases), np.int64)
    for column in phrases.T:
        key = (key << bits) + column
    # Stable sorting merges what is in order already.
    return np.argsort(key, kind="stable")


def new_rows(phrases: np.ndarray) -> np.ndarray:
    """Of rows in order, which differ from the one before."""
    new = np.ones(len(phrases), bool)
    new[1:] = (phrases[1:] != phrases[:-1]).any(axis=1)
    return new


def summed(phrases: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct phrases in order, their sums, number of the distinct phrase of each row)."""
    order = in_order(phrases)
    ordered = phrases[order]
    new = new_rows(ordered)
    at = np.flatnonzero(new)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[at], np.add.reduceat(counts[order], at) if len(at) else counts[:0], number


@dataclass
class CountAutomaton:
    """Arcs of state s are ``first[s]`` to ``first[s + 1]``, by label; state 0 has none."""

    first: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    root: int
    width: int

    def __reduce__(self):
        """Small numbers, most of them the same: they compress well."""
        arcs = (np.diff(self.first), _turned(np.diff(self.label, prepend=0)), self.weight, self.target)
        return _read, (tuple(map(planes, arcs)), self.root, self.width)

    @classmethod
    def of(cls, phrases: np.ndarray, counts: np.ndarray) -> CountAutomaton:
        """Automaton of distinct phrases that come in order. A state is complete when the phrases
        have gone past its beginning; complete states are entered in a register from the ends
        of phrases towards their beginnings, and one that is there already is not stored again."""
        n, width = phrases.shape
        # Arcs of the tree of beginnings: (node they leave, label, weight), node by node.
        leaves, labels, weights, depths = [], [], [], []
        node, made = np.zeros(n, np.int64), 1
        changed = np.zeros(n, bool)
        changed[:1] = True
        for depth in range(width):
            column = phrases[:, depth]
            changed[1:] |= column[1:] != column[:-1]
            at = np.flatnonzero(changed & (column > 0))
            ends = phrases[at, depth + 1] == 0 if depth + 1 < width else np.ones(len(at), bool)
            leaves.append(node[at])
            labels.append(column[at])
            weights.append(np.where(ends, counts[at], 0))
            depths.append(np.full(len(at), depth))
            number = np.cumsum(changed & (column > 0)) + made - 1
            made += len(at)
            node = np.where(column > 0, number, -1)
        parent, label = np.concatenate(leaves), np.concatenate(labels)
        weight, depth = np.concatenate(weights), np.concatenate(depths)
        # Node 1 + i is where arc i leads.
        height = np.zeros(made, np.int64)
        for level in range(width - 1, -1, -1):
            mine = np.flatnonzero(depth == level)
            np.maximum.at(height, parent[mine], height[mine + 1] + 1)
        state = np.zeros(made, np.int64)
        register = _Register()
        for tall in range(1, width + 1):
            arcs = np.flatnonzero(height[parent] == tall)
            if len(arcs):
                arcs = arcs[np.argsort(parent[arcs], kind="stable")]
                owners, numbers = register.enter(parent[arcs], label[arcs], weight[arcs], state[arcs + 1])
                state[owners] = numbers
        return cls(*register.arrays(), int(state[0]), width)

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """(phrases in order, counts)."""
        return self._walk(None)[:2]

    def matched(self, other: CountAutomaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Composition with another automaton: (phrases of this one in order, their counts here,
        their counts there or 0). Both are walked at once, from state to state."""
        return self._walk(other)

    def _walk(self, other: CountAutomaton | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        state = np.array([self.root])
        there = np.array([other.root if other else 0])
        path = np.zeros((1, self.width), np.int64)
        keys = other._keys() if other else None
        found = []
        for depth in range(self.width):
            size = self.first[state + 1] - self.first[state]
            row = np.repeat(np.arange(len(state)), size)
            arc = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + self.first[state][row]
            path = path[row]
            path[:, depth] = self.label[arc]
            count = np.zeros(len(arc), np.int64)
            there = there[row]
            if other:
                there, count = other._step(there, self.label[arc], keys)
            state = self.target[arc].astype(np.int64)
            ends = self.weight[arc] > 0
            found.append((path[ends], self.weight[arc][ends], count[ends]))
        phrases, here, count = (np.concatenate([f[i] for f in found]) for i in range(3))
        if sum(len(f[0]) > 0 for f in found) < 2:
            # Phrases of one length come in order.
            return phrases, here, count
        order = in_order(phrases)
        return phrases[order], here[order], count[order]

    def _keys(self) -> tuple[np.ndarray, np.ndarray]:
        labels, number = np.unique(self.label, return_inverse=True)
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        return labels, owner * len(labels) + number

    def _step(self, state: np.ndarray, label: np.ndarray, keys) -> tuple[np.ndarray, np.ndarray]:
        """(state reached or 0, weight of the arc or 0). Nothing leaves state 0."""
        labels, arcs = keys
        if not len(arcs):
            return np.zeros_like(state), np.zeros_like(state)
        number = np.minimum(np.searchsorted(labels, label), len(labels) - 1)
        key = state * len(labels) + number
        arc = np.minimum(np.searchsorted(arcs, key), len(arcs) - 1)
        hit = (labels[number] == label) & (arcs[arc] == key)
        return np.where(hit, self.target[arc], 0), np.where(hit, self.weight[arc], 0)


def _turned(steps: np.ndarray) -> np.ndarray:
    """Steps up and down as even and odd numbers."""
    return np.where(steps < 0, -2 * steps - 1, 2 * steps)


def planes(values: np.ndarray) -> tuple[int, bytes]:
    """Numbers of 0 or more in as few bytes each as the largest needs, by byte planes."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    parts = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return width, np.ascontiguousarray(parts.T).tobytes()


def from_planes(data: tuple[int, bytes]) -> np.ndarray:
    width, body = data
    parts = np.frombuffer(body, np.uint8).reshape(width, -1)
    out = np.zeros((parts.shape[1], 8), np.uint8)
    out[:, :width] = parts.T
    return out.view("<i8").ravel()


def _read(arcs: tuple, root: int, width: int) -> CountAutomaton:
    size, turned, weight, target = map(from_planes, arcs)
    step = np.where(turned % 2, -(turned + 1) // 2, turned // 2)
    first = np.append(0, np.cumsum(size))
    return CountAutomaton(first, np.cumsum(step), weight, target, root, width)


class _Register:
    """States so far, each once."""

    def __init__(self) -> None:
        self.first = [np.zeros(1, np.int64)]
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.states, self.arcs = 1, 0

    def enter(
        self, owner: np.ndarray, label: np.ndarray, weight: np.ndarray, target: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """States of one height, as arcs by owner: (owners, numbers of their states). States of
        another height are different by themselves."""
        at = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        size = np.diff(np.append(at, len(owner)))
        columns = (label, weight, target)
        code = np.zeros(len(owner), np.uint64)
        for column in columns:
            code = mixed(code * _ODD + column.astype(np.uint64) + np.uint64(1))
        code = np.add.reduceat(code, at) + mixed(size.astype(np.uint64))
        order = np.argsort(code, kind="stable")
        # Equal codes next to each other; equal states if their arcs are equal, one by one.
        x, y = order[:-1], order[1:]
        same = (code[x] == code[y]) & (size[x] == size[y])
        pairs = np.flatnonzero(same)
        step = size[x[pairs]]
        pair = np.repeat(np.arange(len(pairs)), step)
        inside = np.arange(len(pair)) - np.repeat(np.cumsum(step) - step, step)
        a, b = at[x[pairs]][pair] + inside, at[y[pairs]][pair] + inside
        differ = np.zeros(len(pair), bool)
        for column in columns:
            differ |= column[a] != column[b]
        # Two states of one code that differ stay apart; a third one may then be stored twice.
        same[pairs[np.unique(pair[differ])]] = False
        new = np.append(True, ~same)
        chosen = order[new]
        number = np.empty(len(at), np.int64)
        number[order] = np.cumsum(new) - 1 + self.states
        take = np.repeat(at[chosen] - np.cumsum(size[chosen]) + size[chosen], size[chosen])
        take += np.arange(len(take))
        self.parts.append((label[take], weight[take], target[take]))
        self.first.append(np.cumsum(size[chosen]) + self.arcs)
        self.states += len(chosen)
        self.arcs += len(take)
        return owner[at], number

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        none = (np.zeros(0, np.int64),) * 3
        label, weight, target = (np.concatenate(c) for c in zip(none, *self.parts, strict=True))
        first = np.concatenate([np.zeros(1, np.int64), *self.first])
        # State 0 has no arcs.
        return first, label, weight, target


def union(parts: Sequence[CountAutomaton]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(phrases of all in order, sums of their counts, number of each part's phrases in them)."""
    read = [part.phrases() for part in parts]
    phrases, counts, number = summed(
        np.concatenate([p for p, _ in read]), np.concatenate([c for _, c in read])
    )
    return phrases, counts, np.split(number, np.cumsum([len(c) for _, c in read])[:-1])

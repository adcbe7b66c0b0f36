"""Signature trees over sets of 64-bit tokens, and their dual traversal.

A leaf is a set with a bitmap of its tokens; a node has the OR of its children's bitmaps
and the range of their sizes.  Two sets below two nodes can't share more tokens than the
bits both bitmaps have, plus the tokens of a set that share a bit with another one.
Pairs of nodes that can't reach the similarity are dropped with all below them.
"""

from __future__ import annotations

import numpy as np

FAN = 8
#: Words of bitmaps compared at a time.
WORDS_TOGETHER = 2_000_000
#: Pairs of sets compared exactly between two looks at what is linked by now.
PAIRS_TOGETHER = 256


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two ascending token arrays is ``percent`` or more."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


class Groups:
    """Which sets are linked by now, directly or through others."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = int(parent[x])
        return x

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)


class _Level:
    def __init__(self, bits: np.ndarray, low: np.ndarray, high: np.ndarray, extra: np.ndarray) -> None:
        self.bits, self.low, self.high, self.extra = bits, low, high, extra

    def above(self) -> _Level:
        at = np.arange(0, len(self.low), FAN)
        return _Level(
            np.bitwise_or.reduceat(self.bits, at), np.minimum.reduceat(self.low, at),
            np.maximum.reduceat(self.high, at), np.maximum.reduceat(self.extra, at),
        )


class Tree:
    """Sets in the order of ``ids``; level 0 has the sets, each further one ``FAN`` of a node."""

    def __init__(self, sets: list[np.ndarray], ids: np.ndarray, words: int) -> None:
        self.ids = ids
        sizes = np.array([len(sets[i]) for i in ids])
        bits = np.zeros((len(ids), words), np.uint64)
        place = np.concatenate([sets[i] for i in ids]) % np.uint64(64 * words)
        row = np.repeat(np.arange(len(ids)), sizes)
        flat = row * (64 * words) + place.astype(np.int64)
        flat = np.unique(flat)
        marks = np.uint64(1) << (flat % 64).astype(np.uint64)
        np.bitwise_or.at(bits.reshape(-1), flat // 64, marks)
        extra = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [_Level(bits, sizes, sizes, extra)]
        while len(self.levels[-1].low) > 1:
            self.levels.append(self.levels[-1].above())


def _possible(a: _Level, b: _Level, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of nodes may hold linked sets, and a bound of the tokens they share."""
    near = (100 * a.high[i] >= percent * b.low[j]) & (100 * b.high[j] >= percent * a.low[i])
    shared = np.zeros(len(i), np.int64)
    step = max(1, WORDS_TOGETHER // a.bits.shape[1])
    rows = np.flatnonzero(near)
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        shared[part] = np.bitwise_count(a.bits[i[part]] & b.bits[j[part]]).sum(1, dtype=np.int64)
    shared += np.minimum(a.extra[i], b.extra[j])
    return near & (shared * (100 + percent) >= percent * (a.low[i] + b.low[j])), shared


def _single(level: int, tree: Tree, roots: np.ndarray) -> np.ndarray:
    """The group of all sets below each node of a level, -1 where they are of several."""
    groups = roots[tree.ids]
    for _ in range(level):
        at = np.arange(0, len(groups), FAN)
        low, high = np.minimum.reduceat(groups, at), np.maximum.reduceat(groups, at)
        groups = np.where((low == high) & (low >= 0), low, -1)
    return groups


def _below(tree: Tree, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of the nodes of a level, and which of ``nodes`` each is of."""
    n = len(tree.levels[level - 1].low)
    child = nodes[:, None] * FAN + np.arange(FAN)
    owner = np.repeat(np.arange(len(nodes)), FAN).reshape(child.shape)
    there = child < n
    return child[there], owner[there]


def join(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect all sets connected by links within ``left``, or from ``left`` to ``right``.

    ``sets`` are ascending arrays of unique tokens, not empty; ``left`` and ``right`` are
    their numbers.  Pairs within a group that is already connected aren't compared.
    """
    groups, links = Groups(len(sets)), []

    def compare(x: int, y: int) -> None:
        if groups.find(x) != groups.find(y) and linked(sets[x], sets[y], percent):
            groups.join(x, y)
            links.append((x, y))

    def arranged(ids: np.ndarray) -> np.ndarray:
        # by size, roughly; then similar sets mostly have the same least token, so they come to lie together
        return np.array(sorted(ids.tolist(), key=lambda i: (int(np.log(len(sets[i])) * 16), int(sets[i][0]), len(sets[i]))))

    words = 1 << max(2, int(np.ceil(np.log2(max(len(s) for s in sets) / 16))))
    a = Tree(sets, arranged(left), words)
    if right is None:
        b = a
        for x, y in zip(a.ids.tolist(), a.ids[1:].tolist()):
            compare(x, y)
    else:
        b = Tree(sets, arranged(right), words)
    # the taller tree is cut at the height of the other
    level = min(len(a.levels), len(b.levels)) - 1
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.levels[level].low)), np.arange(len(b.levels[level].low)), indexing="ij"))
    while True:
        roots = groups.roots()
        one, other = _single(level, a, roots)[i], _single(level, b, roots)[j]
        open_pair = (one < 0) | (one != other)
        if right is None:
            open_pair &= i <= j if level else i < j
        i, j = i[open_pair], j[open_pair]
        fits, shared = _possible(a.levels[level], b.levels[level], i, j, percent)
        i, j, shared = i[fits], j[fits], shared[fits]
        if level == 0 or not len(i):
            break
        below_i, owner = _below(a, level, i)
        below_j, again = _below(b, level, j[owner])
        i, j, level = below_i[again], below_j, level - 1
    low = a.levels[0].low
    order = np.argsort(low[i] + b.levels[0].low[j] - 2 * shared, kind="stable")  # likely links first
    x, y = a.ids[i[order]], b.ids[j[order]]
    while len(x):
        for p, q in zip(x[:PAIRS_TOGETHER].tolist(), y[:PAIRS_TOGETHER].tolist()):
            compare(p, q)
        x, y = x[PAIRS_TOGETHER:], y[PAIRS_TOGETHER:]
        roots = groups.roots()
        apart = roots[x] != roots[y]
        x, y = x[apart], y[apart]
    return links

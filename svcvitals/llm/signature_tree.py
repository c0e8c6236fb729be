"""Signature trees over token sets and their dual traversal (numpy, inside tasks).

A node covers a run of documents: the OR of their token bitmaps, the range of their set
sizes, and the most tokens any of them has beyond its set bits (tokens that share a bit).
Two documents a and b under nodes A and B have at most
min(excess(A), excess(B)) + |bits(A) & bits(B)| tokens in common, and no more than the
smaller set. Node pairs whose maximum is too small for the similarity are pruned with all
their documents.
"""

from __future__ import annotations

import numpy as np

WORDS = 32
FANOUT = 8
PAIRS = 1 << 15


class SignatureTree:
    """Tree over sorted sets of 64-bit tokens, in the order given."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        n = len(sets)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        tokens = np.concatenate(sets) if n else np.zeros(0, np.uint64)
        bit = (tokens >> np.uint64(40)) % np.uint64(WORDS * 64)
        bits = np.zeros((n, WORDS), dtype=np.uint64)
        np.bitwise_or.at(bits, (np.repeat(np.arange(n), sizes), (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
        excess = sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, excess)]
        while len(self.levels[-1][0]) > FANOUT:
            bits, low, high, excess = self.levels[-1]
            at = np.arange(0, len(bits), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(bits, at, axis=0), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at)))


def _possible(a, i, b, j, percent: int) -> np.ndarray:
    """Node pairs that may hold documents of Jaccard similarity percent / 100 or more."""
    low_a, high_a, low_b, high_b = a[1][i], a[2][i], b[1][j], b[2][j]
    ok = (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
    ok[ok] = _enough(a, i[ok], b, j[ok], percent)
    return ok


def _enough(a, i, b, j, percent: int) -> np.ndarray:
    shared = np.bitwise_count(a[0][i] & b[0][j]).sum(axis=1, dtype=np.int64)
    most = np.minimum(np.minimum(a[3][i], b[3][j]) + shared, np.minimum(a[2][i], b[2][j]))
    return (100 + percent) * most >= percent * (a[1][i] + b[1][j])


def dual_traversal(a: SignatureTree, b: SignatureTree, percent: int):
    """Document pairs (arrays i, j) that the bitmaps and sizes cannot exclude; of one tree
    with itself, each pair once (i < j). Yields at most PAIRS at a time."""
    same = a is b
    top = max(len(a.levels), len(b.levels)) - 1
    level_a, level_b = min(top, len(a.levels) - 1), min(top, len(b.levels) - 1)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(a.levels[level_a][0])), np.arange(len(b.levels[level_b][0])), indexing="ij"))
    stack = [(level_a, level_b, i, j)]
    while stack:
        la, lb, i, j = stack.pop()
        if len(i) > PAIRS:
            stack += [(la, lb, i[k:k + PAIRS], j[k:k + PAIRS]) for k in range(0, len(i), PAIRS)]
            continue
        if same:
            keep = i < j if la == 0 else i <= j
            i, j = i[keep], j[keep]
        keep = _possible(a.levels[la], i, b.levels[lb], j, percent)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if la == 0 and lb == 0:
            yield i, j
            continue
        down_a, down_b = la >= lb, lb >= la  # the higher side goes down first
        child = np.arange(FANOUT)
        if down_a:
            i = i[:, None] * FANOUT + child
            j = np.repeat(j[:, None], FANOUT, axis=1)
            keep = i < len(a.levels[la - 1][0])
            i, j = i[keep], j[keep]
        if down_b:
            j = j[:, None] * FANOUT + child
            i = np.repeat(i[:, None], FANOUT, axis=1)
            keep = j < len(b.levels[lb - 1][0])
            i, j = i[keep], j[keep]
        stack.append((la - down_a, lb - down_b, i, j))


class Union:
    """Disjoint sets with vectorised root lookup."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            top = self.up[self.up]
            if (top == self.up).all():
                return top
            self.up = top

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = int(self.up[x])
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Exact test of two sorted sets: 100 * |x & y| >= percent * |x | y|."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or 100 * len(x) < percent * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def connect(a: SignatureTree, b: SignatureTree, union: Union, base_a: int, base_b: int, percent: int) -> None:
    """Join in ``union`` (nodes: base + position) every linked pair of documents of a and b.
    Pairs that are connected already need no test: they change no component."""
    for i, j in dual_traversal(a, b, percent):
        while len(i):
            roots = union.roots()
            apart = roots[i + base_a] != roots[j + base_b]
            i, j = i[apart], j[apart]
            for x, y in zip(i[:64].tolist(), j[:64].tolist()):
                if union.find(x + base_a) != union.find(y + base_b) and similar(a.sets[x], b.sets[y], percent):
                    union.join(x + base_a, y + base_b)
            i, j = i[64:], j[64:]


__all__ = ["SignatureTree", "dual_traversal", "Union", "similar", "connect"]

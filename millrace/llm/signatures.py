"""Signature trees over token sets: which sets overlap enough to be linked.

A node holds the OR of its sets' bitmaps (one bit for each token's hash), the smallest and
largest size of a set below it, and how far a set's size exceeds its bits. Two nodes are
compared by the largest overlap that any of their sets can have: the bits both hold, plus
that excess. Pairs of nodes whose sizes or bits rule out a link are left, the others are
opened, down to single sets; these are compared token by token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 16

MOST_BITS = 16_384

# Node pairs that are compared at once.
PAIRS = 20_000


def bitmap_bits(size: int) -> int:
    """How many bits the bitmap of a set of ``size`` tokens has."""
    return min(max(256, 1 << (2 * size - 1).bit_length()), MOST_BITS)


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    """The bitmap of a set of hashed tokens, as 64-bit words."""
    held = np.zeros(bits, dtype=np.uint8)
    held[(tokens & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(held, bitorder="little").view(np.uint64)


def folded(mask: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap as it is with fewer bits: tokens go by their lowest bits."""
    return np.bitwise_or.reduce(mask.reshape(-1, bits // 64), axis=0)


class Tree:
    """The nodes over sets given by their bitmaps and sizes, leaves in the given order."""

    def __init__(self, masks: np.ndarray, sizes: np.ndarray) -> None:
        excess = sizes - np.bitwise_count(masks).sum(axis=1, dtype=np.int64)
        self.levels = [(masks, sizes, sizes, excess)]
        while len(self.levels[-1][0]) > FANOUT:
            masks, low, high, excess = self.levels[-1]
            first = np.arange(0, len(masks), FANOUT)
            self.levels.append((
                np.bitwise_or.reduceat(masks, first), np.minimum.reduceat(low, first),
                np.maximum.reduceat(high, first), np.maximum.reduceat(excess, first)))

    def may_link(self, level: int, left: np.ndarray, right: np.ndarray,
                 percent: int) -> np.ndarray:
        """Which pairs of nodes of a level may hold two sets of that Jaccard similarity."""
        masks, low, high, excess = self.levels[level]
        fits = ((100 * high[left] >= percent * low[right])
                & (100 * high[right] >= percent * low[left]))
        at = np.nonzero(fits)[0]
        for start in range(0, len(at), PAIRS):
            part = at[start:start + PAIRS]
            a, b = left[part], right[part]
            shared = np.bitwise_count(masks[a] & masks[b]).sum(axis=1, dtype=np.int64)
            most = np.minimum(shared + np.minimum(excess[a], excess[b]),
                              np.minimum(high[a], high[b]))
            # |A and B| >= t |A or B| is the same as (1 + t) |A and B| >= t (|A| + |B|).
            fits[part] = (100 + percent) * most >= percent * (low[a] + low[b])
        return fits


def _children(nodes: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    first = nodes * FANOUT
    return first, np.minimum(first + FANOUT, below)


def _leaf_pairs(tree: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(sets of a lowest node, sets it may link with, from the node's own first set on)."""
    n, top = len(tree.levels[0][0]), len(tree.levels) - 1
    if top == 0:
        yield np.arange(n), np.arange(n)
        return
    stack = [(top, *np.triu_indices(len(tree.levels[top][0])))]
    while stack:
        level, left, right = stack.pop()
        fits = tree.may_link(level, left, right, percent)
        left, right = left[fits], right[fits]
        for u in np.unique(left)[::-1].tolist() if level > 1 else np.unique(left).tolist():
            partners = right[left == u]
            below = len(tree.levels[level - 1][0])
            (first,), (last,) = _children(np.array([u]), below)
            starts, ends = _children(partners, below)
            own = np.arange(first, last)
            others = np.concatenate([np.arange(s, e) for s, e in zip(starts, ends)])
            if level == 1:
                yield own, others
                continue
            pairs_left, pairs_right = np.repeat(own, len(others)), np.tile(others, len(own))
            ordered = pairs_left <= pairs_right
            stack.append((level - 1, pairs_left[ordered], pairs_right[ordered]))


def rooted(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of 0 to n - 1 the least number that ``pairs`` (rows of two) join it with."""
    root = list(range(n))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for a, b in pairs.tolist():
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return np.array([top(k) for k in range(n)], dtype=np.int64)


class _Forest:
    """Trees of numbers, which pairs join; ``root`` has each number's tree."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.members = {i: [i] for i in range(n)}
        self.pairs: list[tuple[int, int]] = []

    def connect(self, a: int, b: int) -> None:
        keep, drop = self.root[a], self.root[b]
        if keep == drop:
            return
        if len(self.members[keep]) < len(self.members[drop]):
            keep, drop = drop, keep
        moved = self.members.pop(drop)
        self.root[moved] = keep
        self.members[keep].extend(moved)
        self.pairs.append((a, b))


def may_be_joined(masks: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that connect all sets which may be linked, as far as bitmaps and sizes tell.

    Sets connected already are not looked at again, so the pairs, rows of two, are a forest.
    """
    tree, forest = Tree(masks, sizes), _Forest(len(sizes))
    for own, others in _leaf_pairs(tree, percent):
        for a in own.tolist():
            rest = others[(others > a) & (forest.root[others] != forest.root[a])]
            for b in rest[tree.may_link(0, np.full(len(rest), a), rest, percent)].tolist():
                forest.connect(a, b)
    return np.array(forest.pairs, dtype=np.int64).reshape(-1, 2)


def links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all sets which are linked, directly or through others.

    ``sets`` are sorted arrays of distinct hashed tokens, none of them empty. Two are linked
    when 100 * (size of intersection) >= percent * (size of union). A pair that is connected
    already by links found before is not compared again, so the links form a forest; no link
    between two trees of that forest is missed. The order of ``sets`` matters for speed only:
    similar ones should stand together.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    bits = bitmap_bits(int(sizes.max()))
    tree = Tree(np.stack([bitmap(s, bits) for s in sets]), sizes)
    forest = _Forest(len(sets))
    for own, others in _leaf_pairs(tree, percent):
        for a in own.tolist():
            rest = others[(others > a) & (forest.root[others] != forest.root[a])]
            rest = rest[tree.may_link(0, np.full(len(rest), a), rest, percent)]
            if not len(rest):
                continue
            tokens = np.concatenate([sets[b] for b in rest])
            at = np.minimum(np.searchsorted(sets[a], tokens), sizes[a] - 1)
            firsts = np.concatenate(([0], np.cumsum(sizes[rest])[:-1]))
            shared = np.add.reduceat(sets[a][at] == tokens, firsts, dtype=np.int64)
            linked = (100 + percent) * shared >= percent * (sizes[rest] + sizes[a])
            for b in rest[linked].tolist():
                forest.connect(a, b)
    return forest.pairs

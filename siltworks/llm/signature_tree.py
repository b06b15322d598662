"""Similar sets in one block, by dual traversal of signature trees."""

from __future__ import annotations

import numpy as np

FAN = 8
CHUNK = 1 << 15


class Labels:
    """Union-find with the least member as label."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return int(x)

    def all(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up


class Tree:
    """Leaves are sets; a node holds the OR of its leaves' token bitmaps, their size range and slack.

    ``slack`` is the largest (set size - bits set) below a node: a set a below X shares at most
    slack(X) + popcount(OR(X) & OR(Y)) tokens with a set below Y, since every bit of a that Y lacks
    stands for a token that Y lacks.
    """

    def __init__(self, members: np.ndarray, sizes: np.ndarray, bitmaps: np.ndarray):
        bits = np.bitwise_count(bitmaps[members]).sum(1).astype(np.int64)
        own = sizes[members]
        self.levels = [(members, bitmaps[members], own, own, own - bits)]
        while len(self.levels[-1][0]) > 1:
            _, maps, low, high, slack = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((at, np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))

    def possible(self, level: int, x: np.ndarray, other: Tree, y: np.ndarray, share: tuple[int, int]) -> np.ndarray:
        """Which node pairs may hold a similar pair: by sizes first, then by the greatest overlap."""
        _, map_x, low_x, high_x, slack_x = self.levels[level]
        _, map_y, low_y, high_y, slack_y = other.levels[level]
        num, den = share
        ok = (den * high_x[x] >= num * low_y[y]) & (den * high_y[y] >= num * low_x[x])
        x, y = x[ok], y[ok]
        common = np.bitwise_count(map_x[x] & map_y[y]).sum(1).astype(np.int64)
        most = np.minimum(np.minimum(slack_x[x], slack_y[y]) + common, np.minimum(high_x[x], high_y[y]))
        ok[ok] = (num + den) * most >= num * (low_x[x] + low_y[y])  # overlap >= t / (1 + t) * (|a| + |b|)
        return ok


def bitmaps(sets: list[np.ndarray], width: int) -> np.ndarray:
    """One bitmap of ``width`` bits (a multiple of 64) per set, by the tokens' low bits."""
    out = np.zeros((len(sets), width // 64), np.uint64)
    for i, s in enumerate(sets):
        bit = s % np.uint64(width)
        np.bitwise_or.at(out[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def similar(a: np.ndarray, b: np.ndarray, share: tuple[int, int]) -> bool:
    """|a and b| / |a or b| >= share, for sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return share[1] * common >= share[0] * (len(a) + len(b) - common)


def link(sets: list[np.ndarray], share: tuple[int, int], labels: Labels, visiting: np.ndarray | None = None) -> None:
    """Join the labels of all similar sets (with ``visiting``: only pairs of one visiting and one other).

    Pairs that are joined already are skipped, so a group whose members all resemble one another takes
    about one comparison a member; the traversal holds node pairs in chunks.
    """
    sizes = np.array([len(s) for s in sets])
    if visiting is None:
        hub = 0  # the first set: what it is joined with need not meet again
        for i in range(1, len(sets)):
            if similar(sets[hub], sets[i], share):
                labels.join(hub, i)
    width = max(64, 1 << int(2 * sizes.max() - 1).bit_length())
    maps = bitmaps(sets, min(width, 1 << 15))
    now = labels.all()
    order = np.lexsort((np.arange(len(sets)), sizes, now))
    if visiting is None:
        left = right = Tree(order, sizes, maps)
    else:
        left, right = Tree(order[visiting[order]], sizes, maps), Tree(order[~visiting[order]], sizes, maps)
        while len(left.levels) < len(right.levels):
            left.levels.append(_copy_top(left))
        while len(right.levels) < len(left.levels):
            right.levels.append(_copy_top(right))
    top = len(left.levels) - 1
    todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        level, x, y = todo.pop()
        ok = left.possible(level, x, right, y, share)
        x, y = x[ok], y[ok]
        if not len(x):
            continue
        if level == 0:
            a, b = left.levels[0][0][x], right.levels[0][0][y]
            now = labels.all()
            apart = (now[a] != now[b]) if visiting is not None else (now[a] != now[b]) & (x < y)
            for i, j in zip(a[apart].tolist(), b[apart].tolist()):
                if labels.find(i) != labels.find(j) and similar(sets[i], sets[j], share):
                    labels.join(i, j)
            continue
        below_x, below_y = _children(x, len(left.levels[level - 1][0]), left, level), _children(y, len(right.levels[level - 1][0]), right, level)
        pairs_x = np.repeat(below_x, FAN, axis=1).ravel()
        pairs_y = np.tile(below_y, (1, FAN)).ravel()
        good = (pairs_x >= 0) & (pairs_y >= 0)
        if visiting is None:
            good &= pairs_x <= pairs_y
        pairs_x, pairs_y = pairs_x[good], pairs_y[good]
        now = labels.all()
        apart = ~_one_label(left, level - 1, pairs_x, right, pairs_y, now)
        pairs_x, pairs_y = pairs_x[apart], pairs_y[apart]
        todo += [(level - 1, pairs_x[i:i + CHUNK], pairs_y[i:i + CHUNK]) for i in range(0, len(pairs_x), CHUNK)]


def _copy_top(tree: Tree):
    _, maps, low, high, slack = tree.levels[-1]
    return np.zeros(1, np.int64), maps, low, high, slack


def _children(nodes: np.ndarray, n: int, tree: Tree, level: int) -> np.ndarray:
    if len(tree.levels[level][0]) == len(tree.levels[level - 1][0]) == 1:
        out = np.full((len(nodes), FAN), -1)
        out[:, 0] = 0
        return out
    out = nodes[:, None] * FAN + np.arange(FAN)
    out[out >= n] = -1
    return out


def _one_label(left: Tree, level: int, x: np.ndarray, right: Tree, y: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Node pairs all of whose sets are joined already."""
    def range_of(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        low = high = now[tree.levels[0][0]]
        for k in range(level):
            if len(tree.levels[k + 1][0]) == len(low) == 1:
                continue
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        return low, high

    low_x, high_x = range_of(left)
    low_y, high_y = (low_x, high_x) if right is left else range_of(right)
    return (low_x[x] == high_x[x]) & (low_y[y] == high_y[y]) & (low_x[x] == low_y[y])

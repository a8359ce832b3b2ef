"""A hierarchical index of fingerprints in Gray order, for links within a small Hamming distance.

Neighbours in Gray order share long bit patterns. A node holds the bits that all fingerprints below
it agree in, without those its parent holds already, so the differences from the root to a
leaf add up to the Hamming distance. A search drops a whole group as soon as the sum passes the bound, and
also when the group is known to hang together with the searched fingerprint.
"""

from __future__ import annotations

import numpy as np

FAN = 16
#: Entries expanded at once, and rows searched at once (from few to many: the first link up dense groups).
MOST_OPEN = 2_000_000
FIRST_ROWS, MOST_ROWS = 64, 8192


class GrayForest:
    """One index for each run of equal ``group``; ``codes`` ascend in Gray rank within a group."""

    def __init__(self, group: np.ndarray, codes: np.ndarray):
        self.codes = codes
        size = len(codes)
        group = np.concatenate([[0], np.cumsum(group[1:] != group[:-1])])
        shared = np.full(size, ~np.uint64(0))
        levels = [(codes, shared, np.arange(size), np.arange(1, size + 1), group)]
        self.links = []
        while True:
            low, shared, first, end, owner = levels[-1]
            begins = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            if len(begins) == len(owner):
                break
            place = np.arange(len(owner)) - np.repeat(begins, np.diff(np.append(begins, len(owner))))
            starts = np.flatnonzero(place % FAN == 0)
            ends = np.append(starts[1:], len(owner))
            # A bit is shared if it is shared below and equal among the children.
            ones = np.bitwise_and.reduceat(low & shared, starts)
            zeros = np.bitwise_and.reduceat(~low & shared, starts)
            self.links.append((starts, ends))
            levels.append((ones, ones | zeros, first[starts], end[ends - 1], owner[starts]))
        self.levels = levels
        self.root_of_row = group
        self.own = [
            shared & ~np.repeat(levels[i + 1][1], np.diff(np.append(self.links[i][0], len(shared))))
            for i, (_, shared, _, _, _) in enumerate(levels[:-1])
        ]

    def forest(self, bound: int) -> np.ndarray:
        """For each row the first row of its component under links of at most ``bound`` bits."""
        size = len(self.codes)
        self.root = np.arange(size)
        step, row = FIRST_ROWS, 0
        while row < size:
            stop = min(size, row + step)
            self.same = [
                np.where((low := np.minimum.reduceat(self.root, first)) == np.maximum.reduceat(self.root, first), low, -1)
                for _, _, first, _, _ in self.levels
            ]
            rows = np.arange(row, stop)
            self.descend(len(self.levels) - 1, rows, self.root_of_row[rows], np.zeros(len(rows), np.uint8), bound)
            row, step = stop, min(2 * step, MOST_ROWS)
        return self.root

    def descend(self, level: int, rows: np.ndarray, nodes: np.ndarray, sums: np.ndarray, bound: int) -> None:
        if not len(rows):
            return
        if level == 0:
            self.unite(rows, nodes)
            return
        starts, ends = self.links[level - 1]
        counts = ends[nodes] - starts[nodes]
        total = int(counts.sum())
        if total > MOST_OPEN and len(rows) > 1:
            half = len(rows) // 2
            self.descend(level, rows[:half], nodes[:half], sums[:half], bound)
            self.descend(level, rows[half:], nodes[half:], sums[half:], bound)
            return
        offset = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
        below = np.repeat(starts[nodes], counts) + offset
        rows, sums = np.repeat(rows, counts), np.repeat(sums, counts)
        low, _, _, end, _ = self.levels[level - 1]
        wanted = (end[below] - 1 > rows) & (self.same[level - 1][below] != self.root[rows])
        below, rows, sums = below[wanted], rows[wanted], sums[wanted]
        sums = sums + np.bitwise_count((self.codes[rows] ^ low[below]) & self.own[level - 1][below])
        near = sums <= bound
        self.descend(level - 1, rows[near], below[near], sums[near], bound)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := root[root], root):
                root[:] = up


def gray_code(rank: np.ndarray) -> np.ndarray:
    """The fingerprint of each Gray rank."""
    return rank ^ (rank >> np.uint64(1))


def group_links(group: np.ndarray, ranks: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, first fingerprint of its component) that span each component of each group."""
    new = group[1:] != group[:-1]
    alone = np.concatenate([[True], new]) & np.concatenate([new, [True]])
    codes = gray_code(ranks[~alone])
    if not len(codes):
        return codes, codes
    root = GrayForest(group[~alone], codes).forest(bound)
    linked = root != np.arange(len(root))
    return codes[linked], codes[root[linked]]

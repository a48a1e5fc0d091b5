"""Sort-tile-recursive packing of labelled points, and best-first search for high inner products among them.

Points are sorted by label and cut, each part by the first coordinate and cut, and so on, until a part is one leaf; sorts are by value, then by a
random number, so that equal points fill leaves as evenly as others. Every node keeps the smallest box around its points; with a query that
box gives an interval for each coordinate's product, and their sum an interval that holds the inner product of every point inside.
"""

from __future__ import annotations

import heapq

import numpy as np

LEAF = 256  # points of a leaf
FAN = 8  # children of a node


def _parts(left: int, axes: int, labels: int | None = None) -> int:
    """Into how many parts the next axis is cut, so that all axes together give ``left`` parts."""
    if labels is not None:
        return max(1, min(left, labels))
    return max(2, int(np.ceil(left ** (1 / max(axes, 1)) - 1e-9)))


def packed_order(labels: np.ndarray, x: np.ndarray, ties: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Order of the points by leaf, and the number of each one's leaf."""
    groups, axis, left = [np.arange(len(labels))], -1, -(-len(labels) // leaf)
    while left > 1 and axis < x.shape[1]:
        values = labels if axis < 0 else x[:, axis]
        parts = _parts(left, x.shape[1] - axis, len(np.unique(labels)) if axis < 0 else None)
        cut = []
        for own in groups:
            if len(own) > leaf:
                own = own[np.lexsort((ties[own], values[own]))]
                cut += np.array_split(own, min(parts, -(-len(own) // leaf)))
            else:
                cut.append(own)
        groups, left, axis = cut, -(-left // parts), axis + 1
    groups = [part for own in groups for part in np.array_split(own, max(1, -(-len(own) // leaf)))]
    return np.concatenate(groups), np.repeat(np.arange(len(groups)), [len(g) for g in groups])


class Cuts:
    """The upper levels of the packing, learned from a sample: which tile a point belongs to. Every point has one."""

    def __init__(self, labels: np.ndarray, x: np.ndarray, ties: np.ndarray, tiles: int):
        self.count = 0
        self.root = self._cut(labels, x, ties, max(1, tiles), -1)

    def _cut(self, labels, x, ties, left, axis):
        if left <= 1 or axis >= x.shape[1] or len(labels) < 2:
            self.count += 1
            return self.count - 1
        parts = min(_parts(left, x.shape[1] - axis, len(np.unique(labels)) if axis < 0 else None), len(labels))
        if parts < 2:
            return self._cut(labels, x, ties, left, axis + 1)
        values = labels if axis < 0 else x[:, axis]
        order = np.lexsort((ties, values))
        pieces = np.array_split(order, parts)
        borders = [(values[p[0]], ties[p[0]]) for p in pieces[1:]]
        return axis, borders, [self._cut(labels[p], x[p], ties[p], -(-left // parts), axis + 1) for p in pieces]

    def tiles(self, labels: np.ndarray, x: np.ndarray, ties: np.ndarray) -> np.ndarray:
        out = np.zeros(len(labels), np.int64)

        def place(node, rows):
            if isinstance(node, int):
                out[rows] = node
                return
            axis, borders, children = node
            values = (labels if axis < 0 else x[:, axis])[rows]
            side = np.zeros(len(rows), int)
            for value, tie in borders:
                side += (values > value) | ((values == value) & (ties[rows] >= tie))
            for i, child in enumerate(children):
                own = rows[side == i]
                if len(own):
                    place(child, own)
        place(self.root, np.arange(len(labels)))
        return out


class Tree:
    """A packed tree over points in leaf order. ``leaf`` numbers the leaf of each point; equal numbers stand together."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        starts = np.flatnonzero(np.r_[True, leaf[1:] != leaf[:-1]])
        self.starts, self.ends = starts, np.r_[starts[1:], len(leaf)]
        low, high = np.minimum.reduceat(x, starts, axis=0), np.maximum.reduceat(x, starts, axis=0)
        first, last = np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts)
        self.leaves = len(starts)
        levels, offset = [(low, high, first, last)], 0
        self.children: dict[int, range] = {}
        while len(levels[-1][0]) > 1:
            low, high, first, last = levels[-1]
            at = np.arange(0, len(low), FAN)
            above = offset + len(low)
            for i, a in enumerate(at):
                self.children[above + i] = range(offset + a, offset + min(a + FAN, len(low)))
            offset = above
            levels.append((np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0), np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))
        self.low, self.high = (np.concatenate([level[i] for level in levels]) for i in (0, 1))
        self.first, self.last = (np.concatenate([level[i] for level in levels]) for i in (2, 3))
        self.root = len(self.low) - 1

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest inner product that each node (row) can hold for each query (column)."""
        up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        return self.low @ up + self.high @ down, self.high @ up + self.low @ down


class Best:
    """The first ``size`` points by falling score, then rising id, seen so far in one score window."""

    __slots__ = ("size", "low", "high", "kept")

    def __init__(self, size: int, low=-np.inf, high=np.inf):
        self.size, self.low, self.high, self.kept = size, low, high, []

    @property
    def bar(self):
        """A score below this cannot enter any more."""
        return max(self.low, -self.kept[-1][0]) if len(self.kept) == self.size else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.size:
            least = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            enough = scores >= least
            scores, ids = scores[enough], ids[enough]
            if len(scores) > 4 * self.size:  # ties: those above and, of the equal ones, the smallest ids
                above, equal = scores > least, np.sort(ids[scores == least])[:self.size]
                scores, ids = np.r_[scores[above], np.full(len(equal), least, scores.dtype)], np.r_[ids[above], equal]
        self.kept = sorted(self.kept + [(-s, i) for s, i in zip(scores.tolist(), ids.tolist())])[:self.size]


def search(tree: Tree, query: np.ndarray, low: np.ndarray, high: np.ndarray, windows: list[Best], label: int, same: bool, not_id: int | None) -> int:
    """Offers to every window the points of the same or of other labels; best boxes first. Returns the number of leaves looked at.

    ``low`` and ``high`` are the query's columns of :meth:`Tree.intervals`. A box is passed over if it lies outside what every window can still
    take: beyond its ends, or strictly below its last kept score.
    """
    top = max((w.high for w in windows), default=-np.inf)
    looked = 0

    def open_to(node: int) -> bool:
        if same:
            if not tree.first[node] <= label <= tree.last[node]:
                return False
        elif tree.first[node] == label == tree.last[node]:
            return False
        return any(high[node] >= w.bar and low[node] <= w.high for w in windows)

    queue = [(-min(high[tree.root], top), tree.root)] if open_to(tree.root) else []
    while queue:
        _, node = heapq.heappop(queue)
        if not open_to(node):  # a window may have closed meanwhile
            continue
        if node >= tree.leaves:
            for child in tree.children[node]:
                if open_to(child):
                    heapq.heappush(queue, (-min(high[child], top), child))
            continue
        looked += 1
        own = slice(tree.starts[node], tree.ends[node])
        scores, ids, labels = tree.x[own] @ query, tree.ids[own], tree.labels[own]
        wanted = labels == label if same else labels != label
        if not_id is not None:
            wanted &= ids != not_id
        for w in windows:
            fits = wanted & (scores >= w.bar) & (scores <= w.high)
            if fits.any():
                w.offer(scores[fits], ids[fits])
    return looked

"""Nearest rows of one block for the rows of another, inside a task: small boxes of neighbouring rows are left out as a whole."""

from __future__ import annotations

import numpy as np

#: Rows of a box.
BOX_ROWS = 64


def boxes(x: np.ndarray, size: int = BOX_ROWS) -> list[np.ndarray]:
    """Places of the rows of ``x`` in groups of at most ``size``: halves along the widest column, again and again."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        part = x[at]
        half = len(at) // 2
        order = np.argpartition(part[:, (part.max(axis=0) - part.min(axis=0)).argmax()], half)
        todo += [at[order[half:]], at[order[:half]]]
    return out


class Boxes:
    """The rows of a block in the order of their boxes, with the range of every box."""

    def __init__(self, x: np.ndarray, size: int = BOX_ROWS):
        groups = boxes(x, size)
        self.order = np.concatenate(groups)
        self.x = x[self.order]
        self.rows = np.array([len(g) for g in groups])
        self.starts = np.cumsum(self.rows) - self.rows
        self.lo, self.hi = (f.reduceat(self.x, self.starts, axis=0) for f in (np.minimum, np.maximum))

    def gaps(self, a: np.ndarray, metric: str) -> np.ndarray:
        """Distance of every row of ``a`` to every box, added up like ``neighbors.distances``: as rounding keeps order, no row of
        a box is nearer."""
        out = np.zeros((len(a), len(self.lo)))
        for j in range(a.shape[1]):
            gap = np.maximum(np.maximum(self.lo[None, :, j] - a[:, j, None], a[:, j, None] - self.hi[None, :, j]), 0.0)
            if metric == "manhattan":
                out += gap
            elif metric == "chebyshev":
                np.maximum(out, gap, out=out)
            else:
                out += gap * gap
        return out if metric in ("manhattan", "chebyshev") else np.sqrt(out)

    def places(self, picked: np.ndarray) -> np.ndarray:
        """Places (in box order) of the rows of the picked boxes."""
        rows = self.rows[picked]
        return np.arange(rows.sum()) + np.repeat(self.starts[picked] - np.cumsum(rows) + rows, rows)


def search(q: np.ndarray, bound: np.ndarray, ids: np.ndarray, target: Boxes, k: int, least, exact):
    """(row of ``q``, place in ``target``, cost) of the ``k`` rows with the least (cost, id) among those whose cost is not
    above the row's ``bound``. ``ids`` are in box order; ``least(rows)`` gives a lower bound of the cost per box, and
    ``exact(rows, places)`` the costs."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for rows in boxes(q):
        low = least(rows)
        first = np.unique(low.argmin(axis=1))  # every row's nearest box
        if target.rows[first].sum() <= k:
            near = np.argsort(low.min(axis=0), kind="stable")
            first = near[:np.searchsorted(np.cumsum(target.rows[near]), min(k + 1, len(target.x))) + 1]
        limit = bound[rows]
        at = target.places(first)
        cost = exact(rows, at)
        limit = _limit(cost, limit, k)
        more = ~(low > limit[:, None]).all(axis=0)
        more[first] = False
        if more.any():
            others = target.places(np.flatnonzero(more))
            at, cost = np.concatenate([at, others]), np.concatenate([cost, exact(rows, others)], axis=1)
            limit = _limit(cost, limit, k)
        i, j = np.nonzero(~(cost > limit[:, None]))
        found.append((rows[i], at[j], cost[i, j]))
    row, at, cost = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((ids[at], cost, row))
    row, at, cost = row[order], at[order], cost[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], at[keep], cost[keep]


def _limit(cost: np.ndarray, limit: np.ndarray, k: int) -> np.ndarray:
    if cost.shape[1] < k:
        return limit
    return np.fmin(limit, np.partition(cost, k - 1, axis=1)[:, k - 1])

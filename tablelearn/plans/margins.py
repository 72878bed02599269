"""Margin machines by Newton steps on a smooth loss that gets sharper: one pass over the rows a step, sums of d x d."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .sums import lists_to_matrix, sum_vectors

#: Widths of the smoothing, from easy to nearly exact.
BANDS = (1.0, 0.2, 0.04, 8e-3, 1.6e-3, 3e-4, 1e-4)
_STEPS = (0.6, 0.3, 0.1, 0.03, 0.01, 1e-3)
STEPS_PER_BAND = 40


def hinge(z: np.ndarray, y: np.ndarray, band: float, eps: float = 0.0):
    """Loss, slope and bend in z of max(0, 1 - y z), smooth; y is -1 or 1."""
    loss, share, bend = _smooth(1.0 - y * z, band)
    return loss, -share * y, bend


def insensitive(z: np.ndarray, y: np.ndarray, band: float, eps: float):
    """The same of max(0, |z - y| - eps), as the sum of its two sides."""
    over, under = _smooth(z - y - eps, band), _smooth(y - z - eps, band)
    return over[0] + under[0], over[1] - under[1], over[2] + under[2]


def _smooth(a, band):
    """max(0, a) as the upper branch of a hyperbola: value, slope (0 to 1), second derivative. It bends everywhere, so that
    a solution for one band is a good start for the next."""
    root = np.sqrt(a * a + 4 * band * band)
    return (a + root) / 2, (1 + a / root) / 2, 2 * band * band / root**3


def newton_margins(rows: DataFrame, d: int, loss, C: float, eps: float = 0.0, scale: float = 1.0, tol: float = 1e-10):
    """``rows`` (x, y) -> (weights, intercept, passes) with the least 1/2 |w|^2 + C sum loss(x . w + b, y).

    ``scale`` is the size of the loss's argument, by which the bands are multiplied. The result depends on the layout of the
    rows only by rounding; a lost task repeats its own sums.
    """
    upper = np.triu_indices(d + 1)
    bands = [b * scale for b in BANDS]
    if eps > 0 and bands[-1] > eps / 200:
        bands.append(eps / 200)
    w, passes = np.zeros(d + 1), 0

    def look(w, band):
        def part(batch):
            x, y = lists_to_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            x = np.column_stack([x, np.ones(len(y))])
            value, slope, bend = loss(x @ w, y, band, eps)
            square = (x * bend[:, None]).T @ x
            return np.concatenate([[value.sum()], x.T @ slope, square[upper]])

        sums = sum_vectors(rows, part, 2 + d + len(upper[0])) * C
        bent = np.zeros((d + 1, d + 1))
        bent[upper] = sums[2 + d:]
        bent = bent + np.triu(bent, 1).T
        own = np.append(w[:-1], 0.0)
        return sums[0] + 0.5 * own @ own, sums[1:2 + d] + own, bent + np.diag(np.append(np.ones(d), 1e-12))

    def along(w, turn, band):
        def part(batch):
            x, y = lists_to_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            z, dz = x @ w[:-1] + w[-1], x @ turn[:-1] + turn[-1]
            return np.array([loss(z + s * dz, y, band, eps)[0].sum() for s in _STEPS])

        costs = C * sum_vectors(rows, part, len(_STEPS))
        return costs + np.array([0.5 * np.sum((w + s * turn)[:-1] ** 2) for s in _STEPS])

    for band in bands:
        value, slope, bent = look(w, band)
        passes, damping = passes + 1, 0.0
        for _ in range(STEPS_PER_BAND):
            turn = -np.linalg.solve(bent + damping * np.diag(np.diag(bent)), slope)
            gain = -slope @ turn
            if gain <= (tol if band == bands[-1] else 1e-2) * max(abs(value), 1e-12):
                break
            found = look(w + turn, band)
            passes += 1
            if found[0] > value - 1e-4 * gain:
                costs = along(w, turn, band)
                best = int(costs.argmin())
                passes += 1
                if costs[best] >= value:
                    damping = max(10 * damping, 0.01)
                    continue
                turn = _STEPS[best] * turn
                found = look(w + turn, band)
                passes += 1
            w, damping = w + turn, damping / 10 if damping > 1e-4 else 0.0
            value, slope, bent = found
    return w[:-1], float(w[-1]), passes, bands[-1]


def leverage_landmarks(rows: DataFrame, kernel, count: int, candidates: int, seed: int) -> tuple[np.ndarray, float]:
    """``count`` different rows x, and the mean error of the kernel that they span, over the candidates.

    Candidates are the first ``candidates`` different rows by a hash, so the choice does not depend on the layout; all rows
    where there are no more. Each is drawn with a weight of its ridge leverage score, its share in the kernel's spectrum,
    so that rare regions get landmarks of their own.
    """
    picked = rows.select("x").distinct().orderBy(F.xxhash64("x", F.lit(seed)), "x").limit(candidates).collect()
    x = np.array([r.x for r in picked], dtype=float)
    whole = kernel(x, x)
    if len(x) <= count:
        chosen = np.arange(len(x))
    else:
        values, vectors = np.linalg.eigh(whole)
        values = np.maximum(values, 0.0)
        ridge = np.sort(values)[::-1][count:].sum() / count
        scores = (vectors**2 * (values / (values + max(ridge, 1e-12)))).sum(axis=1)
        keys = np.log(np.random.default_rng(seed).random(len(x))) / np.maximum(scores, 1e-12)
        chosen = np.sort(np.argsort(-keys)[:count])
    part = whole[:, chosen] @ spanned(whole[np.ix_(chosen, chosen)])
    return x[chosen], float(np.abs(whole - part @ part.T).mean())


def spanned(square: np.ndarray) -> np.ndarray:
    """The matrix that turns similarities to landmarks into features with those similarities as inner products."""
    values, vectors = np.linalg.eigh(square)
    held = values > 1e-10 * values.max(initial=0.0)
    return vectors[:, held] / np.sqrt(values[held])

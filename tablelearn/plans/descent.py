"""Descent on distributed rows: the driver holds the parameter vector, Spark passes give losses, gradients or averages."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .sums import lists_to_matrix

Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]


def averaged_rounds(
    rows: DataFrame, gradient: Callable, start: np.ndarray, n: int, solver: str, rate: float, max_iter: int, l2: float = 0.0, batch_rows: int = 200,
    tol: float = 1e-4, seed: int = 42,
):
    """Mini-batch descent on (x, y): in a round every task goes through its rows in shuffled mini-batches from the same
    parameters, and the results are averaged by rows. Returns (parameters, last mean loss, rounds); stops after 10
    rounds without an improvement of ``tol``. ``gradient(x, y, w)`` gives [sum of losses, gradient of that sum].
    Only the parameters and their two moments travel."""
    if solver not in ("adam", "sgd"):
        raise ValueError("solver must be adam or sgd")
    size = len(start)
    state = np.concatenate([start, np.zeros(2 * size + 1)])  # parameters, two moments, steps
    best, stale, loss, done = np.inf, 0, np.inf, 0
    for done in range(1, max_iter + 1):

        def work(batches, state=state, done=done):
            w, m, v, steps = state[:size].copy(), state[size : 2 * size].copy(), state[2 * size : 3 * size].copy(), state[-1]
            rng, seen, lost = np.random.default_rng([seed, done]), 0, 0.0
            for batch in batches:
                x, y = lists_to_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
                order = rng.permutation(len(y))
                for at in range(0, len(y), batch_rows):
                    some = order[at : at + batch_rows]
                    found = gradient(x[some], y[some], w)
                    lost, g, steps = lost + found[0], found[1:] / len(some) + l2 * w / n, steps + 1
                    if solver == "adam":
                        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                        w = w - rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)
                    else:
                        m = 0.9 * m - rate * g
                        w = w + m
                seen += len(y)
            if seen:
                values = np.concatenate([np.concatenate([w, m, v, [steps]]) * seen, [lost, seen]])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["pos", "v"])

        total = np.zeros(len(state) + 2)
        for row in rows.mapInArrow(work, "pos int, v double").groupBy("pos").agg(F.sum("v").alias("v")).collect():
            total[row.pos] = row.v
        state, loss = total[:-2] / total[-1], total[-2] / total[-1]
        stale = stale + 1 if loss > best - tol else 0
        best = min(best, loss)
        if stale >= 10:
            break
    return state[:size], float(loss), done


def minimise(objective: Objective, start: np.ndarray, max_iter: int, tol: float = 1e-4):
    """L-BFGS; returns (parameters, last loss, rounds)."""
    return _lbfgs(objective, start, max_iter, tol)


def _lbfgs(objective, w, max_iter, tol, memory=10):
    loss, g = objective(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    done = 0
    for done in range(1, max_iter + 1):
        q, saved = g.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            saved.append(a)
            q -= a * y
        if pairs:
            s, y = pairs[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, np.linalg.norm(g))
        for (s, y), a in zip(pairs, reversed(saved)):
            q += s * (a - (y @ q) / (s @ y))
        slope = -(g @ q)
        if slope >= 0:
            break
        step = 1.0
        for _ in range(20):
            trial = w - step * q
            new_loss, new_g = objective(trial)
            if new_loss <= loss + 1e-4 * step * slope:
                break
            step /= 2
        else:
            break
        s, y = trial - w, new_g - g
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        settled = abs(loss - new_loss) <= tol * max(1.0, abs(loss)) * 1e-3
        w, loss, g = trial, new_loss, new_g
        if settled or np.abs(g).max() <= tol * 1e-2:
            break
    return w, float(loss), done

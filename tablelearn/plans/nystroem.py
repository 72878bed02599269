"""Spectral embedding of a dense Gaussian similarity from landmarks: two sums over the rows, then a projection."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .lineage import checkpointed
from .sums import lists_to_matrix, sum_vectors

LANDMARKS = 256
_BATCH = 4_096


def _similar(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    gap = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.exp(-gamma * np.maximum(gap, 0.0))


class Landmarks:
    """Factor f of rows with f(x) . f(y) = exp(-gamma |x - y|^2) between landmarks, and its Nystroem extension to others."""

    def __init__(self, points: np.ndarray, gamma: float):
        self.points, self.gamma = points, gamma
        values, vectors = np.linalg.eigh(_similar(points, points, gamma))
        held = values > 1e-10 * values.max()
        self.turn = vectors[:, held] / np.sqrt(values[held])

    def factor(self, x: np.ndarray) -> np.ndarray:
        return _similar(x, self.points, self.gamma) @ self.turn


def landmarks(rows: DataFrame, gamma: float, count: int = LANDMARKS) -> Landmarks:
    """``count`` different rows (x), chosen by hash, so that the choice does not depend on the layout; all if there are fewer."""
    picked = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(count).collect()
    return Landmarks(np.array([r.x for r in picked], dtype=float), gamma)


def rbf_embedding(rows: DataFrame, k: int, gamma: float, count: int = LANDMARKS) -> DataFrame:
    """``rows`` (id, x) -> (id, v): the k leading eigenvectors of D^-1/2 W D^-1/2 divided by the root of the degree, for
    W = exp(-gamma d^2) between all rows, with W replaced by its Nystroem form F F'.

    One pass adds up F, which gives every degree; a second adds up F'F with rows weighted by their inverse degree, whose
    eigenvectors are those wanted. No pair of rows meets. With up to ``count`` different rows the result is exact.
    """
    found = landmarks(rows, gamma, count)
    r = found.turn.shape[1]

    def chunks(batch):
        for start in range(0, batch.num_rows, _BATCH):
            yield found.factor(lists_to_matrix(batch.slice(start, _BATCH).column(0)))

    total = sum_vectors(rows.select("x"), lambda batch: sum(f.sum(axis=0) for f in chunks(batch)), r)
    upper = np.triu_indices(r)

    def degrees(f):
        return np.maximum(f @ total, 1e-12)

    def gram(batch):
        return sum(((f / degrees(f)[:, None]).T @ f)[upper] for f in chunks(batch))

    half = np.zeros((r, r))
    half[upper] = sum_vectors(rows.select("x"), gram, len(upper[0]))
    values, vectors = np.linalg.eigh(half + half.T - np.diag(np.diag(half)))
    lead = np.argsort(values)[::-1][:k]
    turn = vectors[:, lead] / np.sqrt(np.maximum(values[lead], 1e-300))

    @F.pandas_udf("array<double>")
    def place(x: pd.Series) -> pd.Series:
        if not len(x):
            return x
        f = np.concatenate([found.factor(np.stack(x.iloc[s:s + _BATCH].to_numpy()).astype(float)) for s in range(0, len(x), _BATCH)])
        return pd.Series(list(f @ turn / degrees(f)[:, None]))

    return checkpointed(rows.select("id", place("x").alias("v")))

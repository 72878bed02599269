"""Cross-validation, leave-one-out and grid search.

Folds are a fixed function of the row id. Least-squares models with moment-based scorers need one data pass for all
folds and all candidates: training statistics are the total minus the fold's own.
"""

from __future__ import annotations

import json
import time
from itertools import product

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import as_double, as_matrix_columns, names, require
from ..plans.moments import Moments, moments_by
from .bayes import _NaiveBayes
from .ensemble import PARALLEL_FITS, fit_all
from .knn import KNNModel
from .linear import LinearRegression, Ridge, _LeastSquares, r_squared
from .metrics import score
from .registry import is_regressor, make
from .split import with_draws, with_folds

METHODS = ("kfold", "stratified", "shuffle", "loo")
FROM_MOMENTS = ("r2", "neg_mean_squared_error")


def _default_scoring(model: str) -> str:
    return "r2" if is_regressor(model) else "accuracy"


def _score(fitted, rows: DataFrame, scoring: str, target: str) -> float:
    out = fitted.transform(rows)
    if scoring == "roc_auc":
        out = out.withColumn("_positive", F.col("probabilities")[1])
        top = fitted.classes[-1]
        return score(out.withColumn("_hit", F.when(F.col(f"`{target}`") == F.lit(top), 1).otherwise(0)), scoring, "_hit", "_positive").first().score
    return score(out, scoring, target).first().score


def _moment_score(m: Moments, fitted, scoring: str) -> float:
    w, b = np.array(fitted.coefficients), fitted.intercept
    r2 = r_squared(m, w, b)
    if scoring == "r2":
        return r2
    return -(1.0 - r2) * m.cross[-1, -1] / m.n


def _fold_parts(df, id_col, target, method, folds, seed):
    """[(train rows, test rows)] over one persisted, tagged table."""
    if method == "shuffle":
        tagged = with_draws(df, id_col, folds, 0.2, seed).persist()
        return tagged, [(tagged.where(f"not _test_{f}"), tagged.where(f"_test_{f}")) for f in range(folds)]
    tagged = with_folds(df, id_col, folds, target if method == "stratified" else None, seed).persist()
    return tagged, [(tagged.where(F.col("_fold") != f), tagged.where(F.col("_fold") == f)) for f in range(folds)]


def _moment_folds(df, op: _LeastSquares, id_col, method, folds, seed):
    """[(train moments, test moments)] from one grouped pass."""
    if method == "shuffle":
        tagged = with_draws(df, id_col, folds, 0.2, seed)
        flags = F.concat(*[F.when(F.col(f"_test_{f}"), "1").otherwise("0") for f in range(folds)])
        tagged = tagged.withColumn("_fold", flags)  # at most 2^folds patterns, in practice few
    else:
        tagged = with_folds(df, id_col, folds, op.target if method == "stratified" else None, seed)
    cols = [*op.cols, op.target]
    data = as_matrix_columns(tagged, cols, op.on_null, keep=["_fold"])
    by = moments_by(data, cols, F.col("_fold"))
    out = []
    for f in range(folds):
        test, train = Moments.zero(len(cols)), Moments.zero(len(cols))
        for key, m in by.items():
            if (key[f] == "1") if method == "shuffle" else key == f:
                test = test + m
            else:
                train = train + m
        out.append((train, test))
    return out


def cross_validate(
    df: DataFrame, id_col: str, model: str, cols, target: str, method="kfold", folds=5, scoring=None, seed=42, params=None,
    parallelism=PARALLEL_FITS,
) -> list[dict]:
    """One dict per fold: fold, test_score, train_score, fit_time, score_time."""
    if method not in METHODS[:3]:
        raise ValueError(f"method must be one of {METHODS[:3]}; leave-one-out has its own function")
    cols, scoring = names(cols), scoring or _default_scoring(model)
    require(df, [id_col, *cols, target])
    op = make(model, cols, target, id_col, **(params or {}))
    if isinstance(op, _LeastSquares) and scoring in FROM_MOMENTS:
        out, began = [], time.time()
        parts = _moment_folds(df, op, id_col, method, folds, seed)
        spent = (time.time() - began) / folds
        for f, (train, test) in enumerate(parts):
            fitted = op.fit_moments(train)
            out.append(dict(fold=f, test_score=_moment_score(test, fitted, scoring), train_score=_moment_score(train, fitted, scoring),
                            fit_time=spent, score_time=0.0))
        return out
    needed = df.select(*dict.fromkeys([id_col, *cols, target]))
    tagged, parts = _fold_parts(needed, id_col, target, method, folds, seed)

    def one(f):
        train, test = parts[f]
        began = time.time()
        fitted = make(model, cols, target, id_col, **(params or {})).fit(train)
        fit_time, began = time.time() - began, time.time()
        row = dict(fold=f, test_score=_score(fitted, test, scoring, target), train_score=_score(fitted, train, scoring, target))
        return row | dict(fit_time=fit_time, score_time=time.time() - began)

    try:
        tagged.count()
        return fit_all([lambda f=f: one(f) for f in range(folds)], parallelism)
    finally:
        tagged.unpersist()


def fold_table(spark, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame(
        [(r["fold"], float(r["test_score"]), float(r["train_score"]), r["fit_time"], r["score_time"]) for r in rows],
        "fold int, test_score double, train_score double, fit_time double, score_time double",
    )


def cv_summary(rows: list[dict]) -> dict:
    test, train = np.array([r["test_score"] for r in rows]), np.array([r["train_score"] for r in rows])
    return dict(n_folds=len(rows), mean_test_score=float(test.mean()), std_test_score=float(test.std()),
                mean_train_score=float(train.mean()), std_train_score=float(train.std()))


def leave_one_out(df: DataFrame, id_col: str, model: str, cols, target: str, scoring=None, params=None) -> DataFrame:
    """(id, test_score) per row, from closed forms: the hat-matrix diagonal for least squares and ridge, each row taken out
    of its class's statistics for naive Bayes, the neighbours without the row itself for KNN. Other models would need
    one refit per row and are refused."""
    cols, scoring = names(cols), scoring or ("neg_mean_squared_error" if is_regressor(model) else "accuracy")
    require(df, [id_col, *cols, target])
    op = make(model, cols, target, id_col, **(params or {}))
    key = F.col(f"`{id_col}`")
    if isinstance(op, (LinearRegression, Ridge)) and scoring in ("neg_mean_squared_error", "neg_mean_absolute_error"):
        m = op.moments(df)
        fitted = op.fit_moments(m)
        gram = m.cross[:-1, :-1] if op.fit_intercept else m.raw_cross()[:-1, :-1]
        inverse = np.linalg.pinv(gram + op.penalties(m.n)["l2"] * np.eye(len(gram)))
        centre = m.mean[:-1] if op.fit_intercept else np.zeros(len(cols))
        xs = [as_double(df, c) - F.lit(float(v)) for c, v in zip(cols, centre)]
        lever = F.lit(1.0 / m.n if op.fit_intercept else 0.0)
        for i, a in enumerate(xs):
            for j, b in enumerate(xs):
                lever = lever + a * b * F.lit(float(inverse[i, j]))
        scored = fitted.transform(df)
        miss = (as_double(df, target) - F.col("prediction")) / (1 - lever)
        value = -miss * miss if scoring == "neg_mean_squared_error" else -F.abs(miss)
        return scored.select(key.alias("id"), value.alias("test_score"))
    if isinstance(op, _NaiveBayes):
        out = op.leave_one_out(df)
    elif isinstance(fitted := op.fit(df), KNNModel):
        out = fitted.transform_by(df, id_col, exclude_self=True)
    else:
        raise ValueError(f"leave-one-out has no closed form for {model} with {scoring}; use kfold")
    y, z = F.col(f"`{target}`"), F.col("prediction")
    values = {
        "accuracy": F.when(y == z, 1.0).otherwise(0.0), "neg_mean_squared_error": -(y.try_cast("double") - z) * (y.try_cast("double") - z),
        "neg_mean_absolute_error": -F.abs(y.try_cast("double") - z),
    }
    if scoring not in values:
        raise ValueError(f"a single test row has no {scoring}")
    return out.select(key.alias("id"), values[scoring].alias("test_score"))


def grid_points(grid) -> list[dict]:
    """All combinations of a {name: [values]} grid, given as a dict, a list of dicts or JSON text."""
    grid = json.loads(grid) if isinstance(grid, str) else grid
    out = []
    for g in grid if isinstance(grid, list) else [grid]:
        keys = sorted(g)
        out += [dict(zip(keys, values)) for values in product(*[g[k] for k in keys])]
    return out


class GridSearchResult:
    """Per-candidate means over the folds, the best one, and the model refitted on all rows."""

    def __init__(self, rows, best_params, best_score, model, scoring):
        self.rows, self.best_params, self.best_score, self.model, self.scoring = rows, best_params, best_score, model, scoring

    def table(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(json.dumps(r["params"], sort_keys=True), r["mean_test"], r["std_test"], r["mean_train"], r["rank"]) for r in self.rows],
            "params string, mean_test_score double, std_test_score double, mean_train_score double, rank_test_score int",
        )


def grid_search(
    df: DataFrame, id_col: str, model: str, cols, target: str, grid, cv=5, scoring=None, seed=42, return_model=True, n_jobs=-1
) -> GridSearchResult:
    """Every grid point on the same folds (stratified for classifiers), concurrently; rank 1 = best, ties share the
    smallest rank. ``n_jobs`` is the number of concurrent fits (-1: the default)."""
    cols, scoring = names(cols), scoring or _default_scoring(model)
    require(df, [id_col, *cols, target])
    candidates = grid_points(grid)
    method = "kfold" if is_regressor(model) else "stratified"
    parallelism = PARALLEL_FITS if n_jobs < 1 else n_jobs
    ops = [make(model, cols, target, id_col, **p) for p in candidates]
    whole = None
    if isinstance(ops[0], _LeastSquares) and scoring in FROM_MOMENTS:
        parts = _moment_folds(df, ops[0], id_col, method, cv, seed)
        scores = []
        for op in ops:
            fitted = [op.fit_moments(train) for train, _ in parts]
            scores.append([(_moment_score(test, m, scoring), _moment_score(train, m, scoring)) for m, (train, test) in zip(fitted, parts)])
        whole = parts[0][0] + parts[0][1]
    else:
        needed = df.select(*dict.fromkeys([id_col, *cols, target]))
        tagged, parts = _fold_parts(needed, id_col, target, method, cv, seed)

        def one(p, f):
            fitted = make(model, cols, target, id_col, **p).fit(parts[f][0])
            return _score(fitted, parts[f][1], scoring, target), _score(fitted, parts[f][0], scoring, target)

        try:
            tagged.count()
            flat = fit_all([lambda p=p, f=f: one(p, f) for p in candidates for f in range(cv)], parallelism)
        finally:
            tagged.unpersist()
        scores = [flat[i * cv : (i + 1) * cv] for i in range(len(candidates))]
    rows = []
    for p, pairs in zip(candidates, scores):
        test, train = np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])
        rows.append(dict(params=p, mean_test=float(test.mean()), std_test=float(test.std()), mean_train=float(train.mean())))
    for r in rows:
        r["rank"] = 1 + sum(o["mean_test"] > r["mean_test"] for o in rows)
    best = min(range(len(rows)), key=lambda i: rows[i]["rank"])
    fitted = None
    if return_model:
        fitted = ops[best].fit_moments(whole) if whole is not None else ops[best].fit(df)
    return GridSearchResult(rows, rows[best]["params"], rows[best]["mean_test"], fitted, scoring)

"""Linear, ridge, lasso, elastic-net and logistic regression.

The least-squares family is fitted from one pass of sufficient statistics (count, means, cross-products): the
driver solves a d x d problem and never sees rows. Any set of folds or penalties re-uses the same pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression as MLLogistic
from pyspark.sql import Column, functions as F

from ..core import Fitted, Operator, with_columns
from ..functions.columns import (
    as_double, as_matrix_columns, class_index, class_map, class_value, feature_array, feature_vector, is_array,
    linear, names, require, sorted_classes,
)
from ..plans.lineage import for_passes
from ..plans.moments import Moments, moments


def linear_score(df, cols: list[str], weights: list[float], intercept: float) -> Column:
    """intercept + x . w over scalar columns or one array column."""
    if len(cols) == 1 and is_array(df, cols[0]):
        products = F.zip_with(feature_array(df, cols), F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
        return F.aggregate(products, F.lit(float(intercept)), lambda a, v: a + v)
    return linear([as_double(df, c) for c in cols], weights, intercept)


def solve(m: Moments, fit_intercept=True, l1=0.0, l2=0.0, max_iter=1000, tol=1e-10):
    """Weights for (1/2)|y - Xw|^2 + l1 |w|_1 + (l2/2) |w|^2 with y the last column. Returns (w, intercept, rounds)."""
    full = m.cross if fit_intercept else m.raw_cross()
    gram, xy = full[:-1, :-1], full[:-1, -1]
    rounds = 1
    if l1 > 0:
        w, rounds = _coordinate_descent(gram, xy, l1, l2, max_iter, tol)
    elif l2 > 0:
        w = np.linalg.solve(gram + l2 * np.eye(len(gram)), xy)
    else:
        w = _least_squares(gram, xy)
    b = float(m.mean[-1] - m.mean[:-1] @ w) if fit_intercept else 0.0
    return w, b, rounds


def _least_squares(gram, xy):
    """Unit-diagonal scaling when the columns are independent; the minimum-norm solution when they are not."""
    size = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    scaled = gram / np.outer(size, size)
    if np.linalg.eigvalsh(scaled)[0] > 1e-11 * len(gram):
        return np.linalg.solve(scaled, xy / size) / size
    return np.linalg.lstsq(gram, xy, rcond=1e-10)[0]


def _coordinate_descent(gram, xy, l1, l2, max_iter, tol):
    """Cyclic soft-threshold updates on the d x d cross-products (no data pass per round)."""
    w = np.zeros(len(xy))
    for round_ in range(1, max_iter + 1):
        step = 0.0
        for j in range(len(w)):
            if gram[j, j] + l2 == 0:
                continue
            rho = xy[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (gram[j, j] + l2)
            step = max(step, abs(new - w[j]))
            w[j] = new
        if step <= tol * max(1.0, np.abs(w).max()):
            break
    return w, round_


def r_squared(m: Moments, w, b) -> float:
    """R^2 of any linear model on the rows behind the moments."""
    residual = m.cross[-1, -1] - 2 * w @ m.cross[:-1, -1] + w @ m.cross[:-1, :-1] @ w
    bias = m.mean[-1] - b - m.mean[:-1] @ w
    sse = max(0.0, residual + m.n * bias * bias)
    return float(1.0 - sse / m.cross[-1, -1]) if m.cross[-1, -1] > 0 else float(sse == 0)


class _LeastSquares(Operator):
    penalty = "none"

    def __init__(self, cols, target, fit_intercept=True, alpha=1.0, l1_ratio=0.5, max_iter=1000, on_null="error"):
        super().__init__()
        self.cols, self.target, self.fit_intercept = names(cols), target, fit_intercept
        self.alpha, self.l1_ratio, self.max_iter, self.on_null = float(alpha), float(l1_ratio), int(max_iter), on_null

    def penalties(self, n: int) -> dict:
        return {"l1": 0.0, "l2": 0.0}

    def moments(self, df) -> Moments:
        data = as_matrix_columns(df, self.cols + [self.target], self.on_null)
        return moments(data, self.cols + [self.target])

    def fit_moments(self, m: Moments) -> "LinearModel":
        if m.n == 0:
            raise ValueError("no rows to fit on")
        w, b, rounds = solve(m, self.fit_intercept, **self.penalties(m.n), max_iter=self.max_iter)
        return LinearModel(
            cols=self.cols, target=self.target, coefficients=[float(v) for v in w], intercept=b,
            r2_score=r_squared(m, w, b), training_samples=m.n, penalty=self.penalty, iterations=rounds,
            non_zero=int((w != 0).sum()),
        )

    def _fit(self, df):
        return self.fit_moments(self.moments(df))


class LinearRegression(_LeastSquares):
    """Ordinary least squares."""


class Ridge(_LeastSquares):
    """|y - Xw|^2 + alpha |w|^2."""

    penalty = "ridge"

    def penalties(self, n):
        return {"l1": 0.0, "l2": self.alpha}


class Lasso(_LeastSquares):
    """1/(2n) |y - Xw|^2 + alpha |w|_1."""

    penalty = "lasso"

    def penalties(self, n):
        return {"l1": self.alpha * n, "l2": 0.0}


class ElasticNet(_LeastSquares):
    """1/(2n) |y - Xw|^2 + alpha r |w|_1 + alpha (1 - r)/2 |w|^2."""

    penalty = "elastic_net"

    def penalties(self, n):
        return {"l1": self.alpha * self.l1_ratio * n, "l2": self.alpha * (1 - self.l1_ratio) * n}


class LinearModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        return with_columns(df, {"prediction": linear_score(df, self.cols, self.coefficients, self.intercept)})


SOLVERS = ("lbfgs", "liblinear", "newton-cg", "sag", "saga")


class LogisticRegression(Operator):
    """L2-penalised logistic regression, binary or softmax. All solver names reach the same optimum here."""

    def __init__(self, cols, target, C=1.0, max_iter=100, solver="lbfgs", tol=1e-6, with_score=True):
        super().__init__()
        if solver not in SOLVERS:
            raise ValueError(f"solver must be one of {SOLVERS}")
        self.cols, self.target, self.C, self.max_iter, self.tol = names(cols), target, float(C), int(max_iter), float(tol)
        self.with_score = with_score

    def _fit(self, df):
        classes = sorted_classes(df, self.target)
        if len(classes) < 2:
            raise ValueError("need at least two classes")
        data = df.select(
            class_index(F.col(f"`{self.target}`"), classes).cast("double").alias("label"), feature_vector(df, self.cols).alias("features")
        ).persist()
        try:
            n = data.count()
            model = MLLogistic(
                regParam=1.0 / (self.C * n), standardization=False, maxIter=self.max_iter, tol=self.tol,
            ).fit(for_passes(data, n))
        finally:
            data.unpersist()
        out = LogisticModel(
            cols=self.cols, target=self.target, classes=classes, coefficients=model.coefficientMatrix.toArray().tolist(),
            intercept=[float(v) for v in model.interceptVector], training_samples=n, accuracy=None,
        )
        if self.with_score:
            out.state["accuracy"] = accuracy(out, df, self.target)
        return out


def accuracy(model, df, target) -> float:
    hit = F.when(F.col("prediction") == F.col(f"`{target}`"), 1.0).otherwise(0.0)
    return model.transform(df).agg(F.avg(hit)).first()[0]


def softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    raised = [F.exp(s - top) for s in scores]
    bottom = sum(raised[1:], raised[0])
    return [r / bottom for r in raised]


class LogisticModel(Fitted):
    def _probabilities(self, df):
        scores = [linear_score(df, self.cols, w, b) for w, b in zip(self.coefficients, self.intercept)]
        if len(scores) == 1:
            p = 1.0 / (1.0 + F.exp(-scores[0]))
            return [1.0 - p, p]
        return softmax(scores)

    def _transform(self, df):
        """prediction, probabilities and class_probabilities, all as column expressions."""
        require(df, self.cols)
        out = df.withColumn("probabilities", F.array(*self._probabilities(df)))
        best = F.array_position("probabilities", F.array_max("probabilities")) - 1
        return out.withColumn("prediction", class_value(best, self.classes)).withColumn(
            "class_probabilities", class_map(F.col("probabilities"), self.classes)
        )

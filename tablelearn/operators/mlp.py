"""Feed-forward networks trained data-parallel: ``adam`` and ``sgd`` run mini-batches in every task and average the
parameters each round; ``lbfgs`` sums the tasks' shares of the full gradient."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.sql import functions as F

from ..core import Fitted, Operator
from ..functions.columns import as_double, class_index, class_map, class_value, feature_array, names, require, sorted_classes
from ..plans.descent import averaged_rounds, minimise
from ..plans.sums import lists_to_matrix, sum_vectors
from .linear import accuracy
from .metrics import regression_metrics
from .trees import MLOperator

ACTIVATIONS = ("relu", "tanh", "logistic", "identity")
L2 = 1e-4


def hidden_layers(text) -> list[int]:
    parts = text.split(",") if isinstance(text, str) else list(text)
    return [int(p) for p in parts if str(p).strip()]


def unpack(flat: np.ndarray, sizes: list[int]):
    layers, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        w = flat[at : at + a * b].reshape(a, b)
        layers.append((w, flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return layers


def activate(z: np.ndarray, kind: str) -> np.ndarray:
    if kind == "relu":
        return np.maximum(z, 0.0)
    if kind == "tanh":
        return np.tanh(z)
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) if kind == "logistic" else z


def slope(a: np.ndarray, kind: str):
    if kind == "relu":
        return (a > 0).astype(float)
    if kind == "tanh":
        return 1.0 - a * a
    return a * (1.0 - a) if kind == "logistic" else 1.0


def forward(x: np.ndarray, layers, kind: str, classify: bool) -> list[np.ndarray]:
    steps = [x]
    for i, (w, b) in enumerate(layers):
        z = steps[-1] @ w + b
        if i < len(layers) - 1:
            z = activate(z, kind)
        elif classify:
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
        steps.append(z)
    return steps


def loss_and_gradient(x, y, flat, sizes, kind, classify) -> np.ndarray:
    """[sum of losses, gradient of that sum] on one block of rows."""
    layers = unpack(flat, sizes)
    steps = forward(x, layers, kind, classify)
    out = steps[-1]
    if classify:
        hot = np.zeros_like(out)
        hot[np.arange(len(y)), y.astype(int)] = 1.0
        loss, delta = -np.log(np.maximum((out * hot).sum(axis=1), 1e-300)).sum(), out - hot
    else:
        delta = out - y[:, None]
        loss = 0.5 * (delta**2).sum()
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        parts.append(np.concatenate([(steps[i].T @ delta).ravel(), delta.sum(axis=0)]))
        if i:
            delta = (delta @ layers[i][0].T) * slope(steps[i], kind)
    return np.concatenate([[loss], *reversed(parts)])


class _MLP(Operator):
    classify = False

    def __init__(self, cols, target, hidden="100,50", activation="relu", solver="adam", learning_rate=0.001, max_iter=200, seed=42, with_score=True):
        super().__init__()
        if activation not in ACTIVATIONS:
            raise ValueError(f"activation must be one of {ACTIVATIONS}")
        if solver not in ("adam", "sgd", "lbfgs"):
            raise ValueError("solver must be adam, sgd or lbfgs")
        self.cols, self.target, self.hidden, self.activation = names(cols), target, hidden_layers(hidden), activation
        self.solver, self.rate, self.max_iter, self.seed, self.with_score = solver, float(learning_rate), int(max_iter), seed, with_score

    def _fit(self, df):
        require(df, [*self.cols, self.target])
        classes = sorted_classes(df, self.target) if self.classify else None
        label = class_index(F.col(f"`{self.target}`"), classes).cast("double") if classes else as_double(df, self.target)
        rows = df.select(feature_array(df, self.cols).alias("x"), label.alias("y")).persist()
        try:
            n, d = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
            if not n:
                raise ValueError("no rows to fit on")
            sizes = [d, *self.hidden, len(classes) if classes else 1]
            rng = np.random.default_rng(self.seed)
            start = []
            for a, b in zip(sizes[:-1], sizes[1:]):
                bound = np.sqrt((2.0 if self.activation == "logistic" else 6.0) / (a + b))
                start += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
            start = np.concatenate(start)
            kind, classify = self.activation, self.classify

            def objective(flat):
                part = lambda batch: loss_and_gradient(
                    lists_to_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False), flat, sizes, kind, classify
                )
                sums = sum_vectors(rows, part, len(flat) + 1) / n
                return sums[0] + 0.5 * L2 * (flat @ flat) / n, sums[1:] + L2 * flat / n

            if self.solver == "lbfgs":
                flat, loss, rounds = minimise(objective, start, self.max_iter)
            else:
                step = lambda x, y, flat: loss_and_gradient(x, y, flat, sizes, kind, classify)
                flat, loss, rounds = averaged_rounds(rows, step, start, n, self.solver, self.rate, self.max_iter, L2, seed=self.seed)
        finally:
            rows.unpersist()
        out = MLPModel(
            cols=self.cols, target=self.target, classes=classes, sizes=sizes, activation=kind, weights=flat.tolist(),
            loss=loss, iterations=rounds, training_samples=n,
        )
        if self.with_score:
            if classify:
                out.state["accuracy"] = accuracy(out, df, self.target)
            else:
                out.state["r2_score"] = regression_metrics(out.transform(df), self.target, "prediction").first().r2
        return out


class MLPRegressor(_MLP):
    pass


class MLPClassifier(_MLP):
    """Softmax output. Logistic activation with lbfgs uses the network of ``pyspark.ml``; the rest the trainer above."""

    classify = True

    def _fit(self, df):
        if self.activation == "logistic" and self.solver == "lbfgs":
            return _NativeMLP(self.cols, self.target, self.hidden, self.max_iter, self.seed, self.with_score).fit(df)
        return super()._fit(df)


class _NativeMLP(MLOperator):
    classify = True

    def __init__(self, cols, target, hidden, max_iter, seed, with_score):
        super().__init__(cols, target, with_score)
        self.hidden, self.max_iter, self.seed = hidden, max_iter, seed

    def _fit(self, df):
        self.inputs = df.select(F.size(feature_array(df, self.cols)).alias("d")).first().d
        return super()._fit(df)

    def estimator(self, classes, n):
        return MultilayerPerceptronClassifier(
            layers=[self.inputs, *self.hidden, len(classes)], maxIter=self.max_iter, seed=self.seed, solver="l-bfgs", **self.columns(),
        )


class MLPModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        flat, sizes, kind, classify = np.array(self.weights), self.sizes, self.activation, self.classes is not None

        @F.pandas_udf("array<double>")
        def run(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(forward(np.stack(x.to_numpy()), unpack(flat, sizes), kind, classify)[-1]))

        out = df.withColumn("_out", run(feature_array(df, self.cols)))
        if not classify:
            return out.withColumn("prediction", F.col("_out")[0]).drop("_out")
        out = out.withColumnRenamed("_out", "probabilities")
        best = F.array_position("probabilities", F.array_max("probabilities")) - 1
        out = out.withColumn("prediction", class_value(best, self.classes))
        return out.withColumn("class_probabilities", class_map(F.col("probabilities"), self.classes))

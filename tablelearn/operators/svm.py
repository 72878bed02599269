"""Support-vector classification and regression.

Kernels become explicit features, so training stays a linear, distributed problem: linear = identity, poly = the
exact degree-3 monomials, rbf = random Fourier features, sigmoid = Nystroem features on a bounded landmark set.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression as MLLogistic
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..core import Fitted, Operator
from ..functions.columns import as_double, class_index, class_map, class_value, feature_array, names, require, sorted_classes
from ..plans.descent import minimise
from ..plans.lineage import for_passes
from ..plans.sums import lists_to_matrix, sum_vectors
from .linear import accuracy
from .metrics import regression_metrics
from .polynomial import monomials

KERNELS = ("rbf", "linear", "poly", "sigmoid")
POLY_DEGREE = 3
EPSILON = 0.1


def _gamma(rows, gamma) -> float:
    """'scale' = 1 / (columns * variance of all entries), 'auto' = 1 / columns, or a number."""
    if isinstance(gamma, (int, float)):
        return float(gamma)
    stats = rows.select(F.size("x").alias("d"), F.explode("x").alias("v")).agg(F.max("d").alias("d"), F.var_pop("v").alias("s")).first()
    if gamma == "auto":
        return 1.0 / stats.d
    if gamma == "scale":
        return 1.0 / (stats.d * stats.s) if stats.s else 1.0
    raise ValueError("gamma must be scale, auto or a number")


def _kernel_state(rows, kernel, gamma, features, seed) -> dict:
    """Everything needed to map a row, as plain lists."""
    if kernel == "linear":
        return {"kernel": kernel}
    g = _gamma(rows, gamma)
    d = len(rows.first().x)
    rng = np.random.default_rng(seed)
    if kernel == "rbf":
        return {
            "kernel": kernel, "gamma": g, "omega": (rng.standard_normal((d, features)) * math.sqrt(2 * g)).tolist(),
            "phase": rng.uniform(0, 2 * math.pi, features).tolist(),
        }
    if kernel == "poly":
        return {"kernel": kernel, "gamma": g, "columns": d}
    picked = rows.orderBy(F.xxhash64("x", F.lit(seed))).limit(features).collect()  # bounded landmark set
    marks = np.unique(np.array([r.x for r in picked]), axis=0)
    values, vectors = np.linalg.eigh(np.tanh(g * marks @ marks.T))
    keep = np.abs(values) > 1e-8 * np.abs(values).max()
    root = vectors[:, keep] / np.sqrt(np.abs(values[keep]))
    return {"kernel": kernel, "gamma": g, "landmarks": marks.tolist(), "root": root.tolist()}


def kernel_features(x: np.ndarray, state: dict) -> np.ndarray:
    kind = state["kernel"]
    if kind == "linear":
        return x
    if kind == "rbf":
        omega = np.array(state["omega"])
        return math.sqrt(2.0 / omega.shape[1]) * np.cos(x @ omega + np.array(state["phase"]))
    if kind == "poly":
        out = []
        for m in monomials(state["columns"], POLY_DEGREE, False, False):
            if len(m) == POLY_DEGREE:
                ways = math.factorial(POLY_DEGREE) / math.prod(math.factorial(m.count(i)) for i in set(m))
                out.append(math.sqrt(ways * state["gamma"] ** POLY_DEGREE) * x[:, list(m)].prod(axis=1))
        return np.column_stack(out)
    return np.tanh(state["gamma"] * x @ np.array(state["landmarks"]).T) @ np.array(state["root"])


def _mapped(state):
    @F.pandas_udf("array<double>")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(list(kernel_features(np.stack(x.to_numpy()), state))) if len(x) else pd.Series([], dtype=object)

    return run


class _SVM(Operator):
    def __init__(self, cols, target, kernel="rbf", C=1.0, gamma="scale", probability=True, features=200, max_iter=100, seed=42, with_score=True):
        super().__init__()
        if kernel not in KERNELS:
            raise ValueError(f"kernel must be one of {KERNELS}")
        self.cols, self.target, self.kernel, self.C, self.gamma = names(cols), target, kernel, float(C), gamma
        self.probability, self.features, self.max_iter, self.seed, self.with_score = probability, features, int(max_iter), seed, with_score

    def _rows(self, df, label):
        rows = df.select(feature_array(df, self.cols).alias("x"), label.alias("y"))
        state = _kernel_state(rows, self.kernel, self.gamma, self.features, self.seed)
        if self.kernel != "linear":
            rows = rows.select(_mapped(state)(F.col("x")).alias("x"), "y")
        return rows, state


class SVC(_SVM):
    """Hinge loss, one linear machine per class (one for two classes). Probabilities by a logistic fit on the margin."""

    def _fit(self, df):
        require(df, [*self.cols, self.target])
        classes = sorted_classes(df, self.target)
        if len(classes) < 2:
            raise ValueError("need at least two classes")
        rows, state = self._rows(df, class_index(F.col(f"`{self.target}`"), classes).cast("double"))
        rows = rows.select(array_to_vector("x").alias("features"), "y").persist()
        machines = []
        try:
            n = rows.count()
            for c in [1] if len(classes) == 2 else range(len(classes)):
                data = for_passes(rows.withColumn("label", F.when(F.col("y") == c, 1.0).otherwise(0.0)), n)
                svm = LinearSVC(regParam=1.0 / (self.C * n), standardization=False, maxIter=self.max_iter).fit(data)
                machine = {"weights": svm.coefficients.toArray().tolist(), "intercept": float(svm.intercept)}
                scored = svm.transform(data)
                margin = vector_to_array("rawPrediction")[1]
                side = F.when(F.col("label") == 1, margin).otherwise(-margin)
                counts = scored.agg(
                    F.sum(F.when((side <= 1) & (F.col("label") == 1), 1).otherwise(0)).alias("inside"),
                    F.sum(F.when((side <= 1) & (F.col("label") == 0), 1).otherwise(0)).alias("outside"),
                ).first()
                machine["support"] = [int(counts.outside), int(counts.inside)]
                if self.probability:
                    platt = MLLogistic(maxIter=50).fit(scored.select(array_to_vector(F.array(margin)).alias("features"), "label"))
                    machine["platt"] = [float(platt.coefficients[0]), float(platt.intercept)]
                machines.append(machine)
        finally:
            rows.unpersist()
        out = SVCModel(cols=self.cols, target=self.target, classes=classes, kernel_state=state, machines=machines, training_samples=n,
                       n_support=sum(sum(m["support"]) for m in machines))
        if self.with_score:
            out.state["accuracy"] = accuracy(out, df, self.target)
        return out


class SVCModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        state = self.kernel_state
        w = np.array([m["weights"] for m in self.machines]).T
        b = np.array([m["intercept"] for m in self.machines])

        @F.pandas_udf("array<double>")
        def margins(x: pd.Series) -> pd.Series:
            return pd.Series(list(kernel_features(np.stack(x.to_numpy()), state) @ w + b)) if len(x) else pd.Series([], dtype=object)

        out = df.withColumn("_margin", margins(feature_array(df, self.cols)))
        if len(self.machines) == 1:
            best = F.when(F.col("_margin")[0] > 0, 1).otherwise(0)
        else:
            best = F.array_position("_margin", F.array_max("_margin")) - 1
        out = out.withColumn("prediction", class_value(best, self.classes))
        if all("platt" in m for m in self.machines):
            shares = [1.0 / (1.0 + F.exp(-(F.col("_margin")[i] * m["platt"][0] + m["platt"][1]))) for i, m in enumerate(self.machines)]
            if len(shares) == 1:
                shares = [1.0 - shares[0], shares[0]]
            whole = sum(shares[1:], shares[0])
            out = out.withColumn("probabilities", F.array(*[s / whole for s in shares]))
            out = out.withColumn("class_probabilities", class_map(F.col("probabilities"), self.classes))
        return out.withColumnRenamed("_margin", "decision")


class SVR(_SVM):
    """1/2 |w|^2 + C * sum max(0, |y - f| - epsilon), rounded off in a thin band so that L-BFGS applies."""

    def __init__(self, *args, epsilon=EPSILON, **kw):
        super().__init__(*args, **kw)
        self.epsilon = float(epsilon)

    def _fit(self, df):
        require(df, [*self.cols, self.target])
        rows, state = self._rows(df, as_double(df, self.target))
        rows = rows.persist()
        try:
            n, middle, spread, d = rows.agg(F.count(F.lit(1)), F.avg("y"), F.stddev_pop("y"), F.max(F.size("x"))).first()
            eps, band, C = self.epsilon, max(1e-3 * (spread or 1.0), 1e-9), self.C

            def objective(w):
                def part(batch):
                    x, y = lists_to_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
                    gap = x @ w[:-1] + w[-1] - y
                    over = np.maximum(np.abs(gap) - eps, 0.0)
                    soft = over < band
                    loss = np.where(soft, over**2 / (2 * band), over - band / 2).sum()
                    pull = np.sign(gap) * np.where(soft, over / band, 1.0)
                    return np.concatenate([[loss], x.T @ pull, [pull.sum()]])

                sums = sum_vectors(rows, part, len(w) + 1) / n
                ridge = np.append(w[:-1], 0.0) / (C * n)
                return sums[0] + 0.5 * (w[:-1] @ w[:-1]) / (C * n), sums[1:] + ridge

            start = np.append(np.zeros(d), middle)
            w, loss, rounds = minimise(objective, start, self.max_iter)
            model = SVRModel(
                cols=self.cols, target=self.target, kernel_state=state, weights=w[:-1].tolist(), intercept=float(w[-1]),
                iterations=rounds, training_samples=n, epsilon=eps,
            )
        finally:
            rows.unpersist()
        scored = model.transform(df)
        off = F.abs(as_double(df, self.target) - F.col("prediction")) >= eps
        model.state["n_support"] = scored.agg(F.sum(F.when(off, 1).otherwise(0))).first()[0]
        if self.with_score:
            model.state["r2_score"] = regression_metrics(scored, self.target, "prediction").first().r2
        return model


class SVRModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        state, w, b = self.kernel_state, np.array(self.weights), self.intercept

        @F.pandas_udf("double")
        def run(x: pd.Series) -> pd.Series:
            return pd.Series(kernel_features(np.stack(x.to_numpy()), state) @ w + b) if len(x) else pd.Series([], dtype=float)

        return df.withColumn("prediction", run(feature_array(df, self.cols)))

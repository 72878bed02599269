"""Feature scores and selection. Scores come from grouped aggregates; only one number per column reaches the driver."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import LogisticRegression as MLLogistic
from pyspark.ml.classification import RandomForestClassifier as MLForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor as MLForestRegressor
from pyspark.sql import DataFrame, functions as F

from ..core import Fitted, Operator, with_columns
from ..functions.columns import as_double, as_matrix_columns, class_index, names, require, sorted_classes
from ..plans import information
from ..plans.lineage import checkpointed
from ..plans.moments import moments
from .linear import solve

BINNED = ("mutual_info_classif_binned", "mutual_info_regression_binned")
SCORES = ("f_classif", "f_regression", "chi2", "mutual_info_classif", "mutual_info_regression", *BINNED)
MI_BINS = 10


def _by_class(df, cols, target, **aggs):
    """Row count ``n`` and the given aggregates of all columns per target value; it stays a table, as a target may have
    as many values as rows."""
    data = as_matrix_columns(df, cols, keep=[target])
    exprs = [fn(F.col(f"`{c}`")).alias(f"{k}{i}") for k, fn in aggs.items() for i, c in enumerate(cols)]
    return data.groupBy(F.col(f"`{target}`").alias("c")).agg(F.count(F.lit(1)).alias("n"), *exprs)


def _numbers(row, name, size):
    return np.array([row[f"{name}{i}"] for i in range(size)], dtype=float)


def f_classif(df: DataFrame, cols: list[str], target: str) -> list[float]:
    """ANOVA F: between-class over within-class mean square."""
    classes, size = checkpointed(_by_class(df, cols, target, mean=F.avg, var=F.var_pop)), len(cols)
    first = classes.agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("k"),
        *[F.sum(F.col("n") * F.col(f"mean{i}")).alias(f"sum{i}") for i in range(size)],
        *[F.sum(F.col("n") * F.col(f"var{i}")).alias(f"within{i}") for i in range(size)]).first()
    middle = _numbers(first, "sum", size) / first["rows"]
    second = classes.agg(*[F.sum(F.col("n") * (F.col(f"mean{i}") - F.lit(float(m))) ** 2).alias(f"between{i}") for i, m in enumerate(middle)]).first()
    with np.errstate(divide="ignore", invalid="ignore"):
        between = _numbers(second, "between", size) / np.float64(first["k"] - 1)
        within = _numbers(first, "within", size) / np.float64(first["rows"] - first["k"])
        return (between / within).tolist()


def chi2(df: DataFrame, cols: list[str], target: str) -> list[float]:
    """Chi-square of the per-class sums of non-negative features."""
    checked = lambda c: F.sum(F.when(c < 0, F.raise_error(F.lit("negative value")).cast("double")).otherwise(c))
    classes, size = checkpointed(_by_class(df, cols, target, sums=checked)), len(cols)
    first = classes.agg(F.sum("n").alias("rows"), *[F.sum(f"sums{i}").alias(f"all{i}") for i in range(size)]).first()
    rate = _numbers(first, "all", size) / first["rows"]
    expected = [F.col("n") * F.lit(float(r)) for r in rate]
    parts = [F.sum((F.col(f"sums{i}") - e) ** 2 / F.when(e != 0, e)).alias(f"x{i}") for i, e in enumerate(expected)]
    return [float("nan") if v is None else float(v) for v in classes.agg(*parts).first()]


def f_regression(df: DataFrame, cols: list[str], target: str) -> list[float]:
    """r^2 / (1 - r^2) * (n - 2)."""
    m = moments(as_matrix_columns(df, [*cols, target]), [*cols, target])
    size = np.sqrt(np.diag(m.cross))
    with np.errstate(divide="ignore", invalid="ignore"):
        r2 = (m.cross[:-1, -1] / (size[:-1] * size[-1])) ** 2
        return (r2 / (1 - r2) * (m.n - 2)).tolist()


def _bin(x, lo, hi, bins):
    if hi <= lo:
        return F.lit(0)
    return F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")


def mutual_info(df: DataFrame, cols: list[str], target: str, regression: bool, neighbors: int = 3) -> list[float]:
    """Mutual information (nats) of each feature with the class, or with a numeric target, from nearest neighbours.

    No noise is added: copies of a value are counted as such, so the result does not depend on a seed. For a numeric
    target both columns are scaled to variance 1 first.
    """
    if not regression:
        data = as_matrix_columns(df, cols, keep=[target])
        label = F.coalesce(F.col(f"`{target}`").cast("string"), F.raise_error(F.lit(f"missing value in column {target}")).cast("string"))
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("j"), F.col(f"`{c}`").alias("x")) for i, c in enumerate(cols)]))
        found = information.with_class(data.select(label.alias("c"), cells.alias("e")).select("e.j", "c", "e.x"), neighbors)
        return [found.get(i, 0.0) for i in range(len(cols))]
    numeric = [*cols, target]
    data = as_matrix_columns(df, numeric)
    wide = data.agg(*[F.stddev_pop(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(numeric)]).first()
    scaled = [F.col(f"`{c}`") / F.lit(wide[f"d{i}"] or 1.0) for i, c in enumerate(numeric)]
    return [information.with_number(data.select(scaled[i].alias("x"), scaled[-1].alias("y")), neighbors) for i in range(len(cols))]


def mutual_info_binned(df: DataFrame, cols: list[str], target: str, regression: bool, bins: int = MI_BINS) -> list[float]:
    """Mutual information (nats) of each equal-width binned feature with the class, or with the binned target."""
    numeric = [*cols, target] if regression else cols
    data = as_matrix_columns(df, numeric, keep=[] if regression else [target])
    ends = data.agg(*[f(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(numeric) for k, f in (("lo", F.min), ("hi", F.max))]).first()
    cut = [_bin(F.col(f"`{c}`"), ends[f"lo{i}"], ends[f"hi{i}"], bins) for i, c in enumerate(numeric)]
    label = (cut[-1] if regression else F.col(f"`{target}`")).cast("string")
    cells = F.array(*[F.struct(F.lit(i).alias("j"), b.cast("int").alias("b")) for i, b in enumerate(cut[: len(cols)])])
    counts = checkpointed(data.select(label.alias("y"), F.explode(cells).alias("e")).groupBy("e.j", "e.b", "y").agg(F.count(F.lit(1)).alias("n")))

    def entropy_sums(grouped):  # sum of n log n per column
        return {r["j"]: (r["s"], r["n"]) for r in grouped.groupBy("j").agg(F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("s"), F.sum("n").alias("n")).collect()}

    both = entropy_sums(counts)
    by_bin = entropy_sums(counts.groupBy("j", "b").agg(F.sum("n").alias("n")))
    by_label = entropy_sums(counts.groupBy("j", "y").agg(F.sum("n").alias("n")))
    out = []
    for j in range(len(cols)):
        n = both[j][1]
        out.append(max(0.0, (both[j][0] - by_bin[j][0] - by_label[j][0] + n * math.log(n)) / n))
    return out


def score_features(df: DataFrame, cols, target: str, score_func: str) -> list[float]:
    cols = names(cols)
    require(df, [*cols, target])
    if score_func == "f_classif":
        return f_classif(df, cols, target)
    if score_func == "f_regression":
        return f_regression(df, cols, target)
    if score_func == "chi2":
        return chi2(df, cols, target)
    if score_func in BINNED:
        return mutual_info_binned(df, cols, target, "regression" in score_func)
    if score_func in SCORES:
        return mutual_info(df, cols, target, score_func.endswith("regression"))
    raise ValueError(f"score_func must be one of {SCORES}")


class SelectedModel(Fitted):
    """Keeps the chosen columns as ``selected_<col>``; scores, variances or rankings are in the state."""

    def selected(self) -> list[str]:
        return [c for c, keep in zip(self.cols, self.support_mask) if keep]

    def _transform(self, df):
        require(df, self.selected())
        return with_columns(df, {f"selected_{c}": as_double(df, c) for c in self.selected()})

    def report(self, spark) -> DataFrame:
        values = [float(v) for v in self.state["scores"]]
        return spark.createDataFrame(list(zip(self.cols, values, self.support_mask)), "feature string, score double, selected boolean")


class SelectKBest(Operator):
    def __init__(self, cols, target, k=5, score_func="f_classif"):
        super().__init__()
        self.cols, self.target, self.k, self.score_func = names(cols), target, int(k), score_func

    def _fit(self, df):
        scores = score_features(df, self.cols, self.target, self.score_func)
        ranked = np.argsort(np.nan_to_num(scores, nan=-np.inf), kind="mergesort")  # on a tie the later column wins
        keep = set(ranked[-self.k :].tolist()) if self.k > 0 else set()
        return SelectedModel(cols=self.cols, scores=scores, support_mask=[i in keep for i in range(len(scores))], score_func=self.score_func)


class SelectPercentile(Operator):
    def __init__(self, cols, target, percentile=50, score_func="f_classif"):
        super().__init__()
        self.cols, self.target, self.percentile, self.score_func = names(cols), target, float(percentile), score_func

    def _fit(self, df):
        scores = score_features(df, self.cols, self.target, self.score_func)
        clean = np.nan_to_num(np.array(scores), nan=-np.finfo(float).max)
        cut = np.percentile(clean, 100 - self.percentile)
        mask = clean > cut
        room = int(len(clean) * self.percentile / 100) - int(mask.sum())
        mask[np.flatnonzero(clean == cut)[: max(room, 0)]] = True
        if self.percentile == 100:
            mask[:] = True
        return SelectedModel(cols=self.cols, scores=scores, support_mask=mask.tolist(), score_func=self.score_func)


class VarianceThreshold(Operator):
    """Keep columns whose population variance is above the threshold."""

    def __init__(self, cols, threshold=0.0):
        super().__init__()
        self.cols, self.threshold = names(cols), float(threshold)

    def _fit(self, df):
        data = as_matrix_columns(df, self.cols)
        row = data.agg(*[F.var_pop(f"`{c}`").alias(f"v{i}") for i, c in enumerate(self.cols)]).first()
        mask = [v is not None and v > self.threshold for v in row]
        if not any(mask):
            raise ValueError("no column is above the variance threshold")
        return SelectedModel(cols=self.cols, scores=list(row), support_mask=mask, score_func="variance")


RFE_ESTIMATORS = ("LogisticRegression", "RandomForestClassifier", "LinearRegression", "RandomForestRegressor")


class RFE(Operator):
    """Drop the weakest column one at a time until ``k`` are left. Ranking 1 = kept, 2 = dropped last, ...

    Linear regression needs a single data pass: every refit uses a sub-block of the same cross-products.
    """

    def __init__(self, cols, target, k=5, estimator="LogisticRegression", seed=42):
        super().__init__()
        if estimator not in RFE_ESTIMATORS:
            raise ValueError(f"estimator must be one of {RFE_ESTIMATORS}")
        self.cols, self.target, self.k, self.estimator, self.seed = names(cols), target, int(k), estimator, seed

    def _fit(self, df):
        left = list(range(len(self.cols)))
        ranking = [1] * len(left)
        weigh, release = self._importances(df)
        try:
            while len(left) > max(self.k, 1):
                weights = weigh(left)
                drop = left[int(np.argmin(weights))]
                ranking[drop] = len(left) - max(self.k, 1) + 1
                left.remove(drop)
        finally:
            release()
        return SelectedModel(cols=self.cols, scores=ranking, support_mask=[r == 1 for r in ranking], score_func="rfe")

    def _importances(self, df):
        if self.estimator == "LinearRegression":
            m = moments(as_matrix_columns(df, [*self.cols, self.target]), [*self.cols, self.target])

            def from_moments(left):
                pick = [*left, len(self.cols)]
                return solve(type(m)(m.n, m.mean[pick], m.cross[np.ix_(pick, pick)]))[0] ** 2

            return from_moments, lambda: None
        classes = sorted_classes(df, self.target) if self.estimator != "RandomForestRegressor" else None
        label = class_index(F.col(f"`{self.target}`"), classes).cast("double") if classes else as_double(df, self.target)
        data = as_matrix_columns(df.withColumn("_label", label), self.cols, keep=["_label"]).persist()
        n = data.count()

        def from_fit(left):
            rows = VectorAssembler(inputCols=[self.cols[i] for i in left], outputCol="features").transform(data)
            rows = rows.select("features", F.col("_label").alias("label"))
            if self.estimator == "LogisticRegression":
                fitted = MLLogistic(regParam=1.0 / n, standardization=False).fit(rows)
                return (fitted.coefficientMatrix.toArray() ** 2).sum(axis=0)
            kind = MLForestClassifier if classes else MLForestRegressor
            return kind(numTrees=100, maxDepth=10, seed=self.seed).fit(rows).featureImportances.toArray()

        return from_fit, data.unpersist

"""Voting, stacking and probability calibration over member classifiers."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression as MLLogistic
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..core import Fitted, Operator
from ..functions.columns import class_index, class_map, class_value, names, require, sorted_classes
from ..plans.lineage import checkpointed, for_passes
from ..plans.monotone import curve_pieces, interpolated, monotone_pools
from .linear import accuracy
from .registry import CLASSIFIERS, make
from .split import with_folds

PARALLEL_FITS = 4


def fit_all(jobs, parallelism: int = PARALLEL_FITS) -> list:
    """Run independent fits as concurrent Spark jobs."""
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        spark = SparkSession.getActiveSession()
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs])


def _members(estimators, cols, target, id_col, params):
    for name in estimators:
        if name not in CLASSIFIERS:
            raise ValueError(f"unknown classifier {name}")
    return [make(name, cols, target, id_col, **(params or {}).get(name, {})) for name in estimators]


def _scored(df: DataFrame, model, tag: str) -> DataFrame:
    """The member's output as ``<tag>_prediction`` and ``<tag>_probabilities``."""
    out = model.transform(df).withColumnRenamed("prediction", f"{tag}_prediction")
    out = out.withColumnRenamed("probabilities", f"{tag}_probabilities")
    return out.drop("class_probabilities", "decision", "neighbor_distances", "neighbor_ids", "_probability")


class EnsembleModel(Fitted):
    """Holds fitted members."""

    members: list = None

    def to_json(self):
        raise ValueError("an ensemble is saved with save_fitted(spark, model, path)")

    def parts(self):
        return {str(i): m for i, m in enumerate(self.members)}

    def attach(self, parts, tables):
        self.members = [parts[str(i)] for i in range(len(parts))]

    def summary(self, spark):
        flat = {k: v if isinstance(v, (int, float, str, bool)) else str(v) for k, v in self.state.items() if v is not None}
        return spark.createDataFrame([tuple(flat.values())], list(flat))


class VotingClassifier(Operator):
    """Members fitted on the same rows; ``hard`` = majority (tie: smallest class), ``soft`` = best mean probability."""

    def __init__(self, cols, target, estimators=("LogisticRegression", "RandomForestClassifier", "GaussianNB"), voting="soft",
                 id_col=None, params=None, parallelism=PARALLEL_FITS):
        super().__init__()
        if voting not in ("hard", "soft"):
            raise ValueError("voting must be hard or soft")
        self.cols, self.target, self.estimators, self.voting = names(cols), target, list(estimators), voting
        self.id_col, self.member_params, self.parallelism = id_col, params, parallelism

    def _fit(self, df):
        require(df, [*self.cols, self.target])
        kept = df.select(*dict.fromkeys([*self.cols, self.target, *([self.id_col] if self.id_col else [])])).persist()
        try:
            n = kept.count()
            needed = for_passes(kept, n)
            ops = _members(self.estimators, self.cols, self.target, self.id_col, self.member_params)
            fitted = fit_all([lambda op=op: op.fit(needed) for op in ops], self.parallelism)
            model = VotingModel(
                cols=self.cols, target=self.target, estimators=self.estimators, voting=self.voting,
                classes=sorted_classes(needed, self.target), training_samples=n,
            )
            model.members = fitted
            model.state["accuracy"] = accuracy(model, needed, self.target)
        finally:
            kept.unpersist()
        return model


def combine_votes(df: DataFrame, tags: list[str], classes: list, voting: str) -> DataFrame:
    """Final ``prediction`` (and soft ``probabilities``) from the members' columns."""
    if voting == "soft":
        each = [F.col(f"{t}_probabilities") for t in tags]
        mean = F.array(*[sum((p[i] for p in each[1:]), each[0][i]) / len(each) for i in range(len(classes))])
        df = df.withColumn("probabilities", mean)
        score = F.col("probabilities")
        df = df.withColumn("class_probabilities", class_map(score, classes))
    else:
        votes = [class_index(F.col(f"{t}_prediction"), classes) for t in tags]
        score = F.array(*[sum((F.when(v == i, 1).otherwise(0) for v in votes[1:]), F.when(votes[0] == i, 1).otherwise(0)) for i in range(len(classes))])
    best = F.array_position(score, F.array_max(score)) - 1
    return df.withColumn("prediction", class_value(best, classes))


class VotingModel(EnsembleModel):
    def member_scores(self, df):
        out, tags = df, []
        for i, m in enumerate(self.members):
            tags.append(f"_m{i}")
            out = _scored(out, m, tags[-1])
        return out, tags

    def _transform(self, df):
        out, tags = self.member_scores(df)
        out = combine_votes(out, tags, self.classes, self.voting)
        return out.drop(*[f"{t}_{k}" for t in tags for k in ("prediction", "probabilities")])


FINALS = ("LogisticRegression", "RandomForestClassifier", "GradientBoostingClassifier")


class StackingClassifier(Operator):
    """The final estimator learns from out-of-fold member probabilities; members are then refitted on all rows."""

    def __init__(self, cols, target, id_col, estimators=("RandomForestClassifier", "GradientBoostingClassifier"), final="LogisticRegression",
                 cv=5, seed=42, params=None, parallelism=PARALLEL_FITS):
        super().__init__()
        if final not in FINALS:
            raise ValueError(f"final must be one of {FINALS}")
        self.cols, self.target, self.id_col, self.estimators = names(cols), target, id_col, list(estimators)
        self.final, self.cv, self.seed, self.member_params, self.parallelism = final, int(cv), seed, params, parallelism

    def _fit(self, df):
        require(df, [*self.cols, self.target, self.id_col])
        classes = sorted_classes(df, self.target)
        needed = df.select(*dict.fromkeys([self.id_col, *self.cols, self.target]))
        kept = with_folds(needed, self.id_col, self.cv, self.target, self.seed).persist()
        try:
            n = kept.count()
            folded = for_passes(kept, n)

            def one(fold):
                train = folded.where(F.col("_fold") != fold)
                out = folded.where(F.col("_fold") == fold)
                for i, op in enumerate(_members(self.estimators, self.cols, self.target, self.id_col, self.member_params)):
                    out = _scored(out, op.fit(train), f"_m{i}")
                return _meta(out, len(self.estimators), len(classes)).select(*_meta_names(len(self.estimators), len(classes)), self.target)

            parts = fit_all([lambda f=f: one(f) for f in range(self.cv)], self.parallelism)
            held = parts[0]
            for p in parts[1:]:
                held = held.unionByName(p)
            held = checkpointed(held)
            final = make(self.final, _meta_names(len(self.estimators), len(classes)), self.target, **(self.member_params or {}).get(self.final, {})).fit(held)
            ops = _members(self.estimators, self.cols, self.target, self.id_col, self.member_params)
            fitted = fit_all([lambda op=op: op.fit(folded) for op in ops], self.parallelism)
            model = StackingModel(
                cols=self.cols, target=self.target, estimators=self.estimators, final=self.final, cv=self.cv, classes=classes,
                training_samples=n,
            )
            model.members, model.last = fitted, final
            model.state["accuracy"] = accuracy(model, folded, self.target)
        finally:
            kept.unpersist()
        return model


def _meta_names(members: int, classes: int) -> list[str]:
    """One column per member and class; with two classes only the second one."""
    return [f"_meta_{i}_{c}" for i in range(members) for c in (range(classes) if classes > 2 else [1])]


def _meta(df, members, classes):
    new = {n: F.col(f"_m{n.split('_')[2]}_probabilities")[int(n.split("_")[3])] for n in _meta_names(members, classes)}
    return df.withColumns(new)


class StackingModel(EnsembleModel):
    last = None

    def parts(self):
        return super().parts() | {"last": self.last}

    def attach(self, parts, tables):
        self.last = parts.pop("last")
        super().attach(parts, tables)

    def _transform(self, df):
        out = df
        for i, m in enumerate(self.members):
            out = _scored(out, m, f"_m{i}")
        out = _meta(out, len(self.members), len(self.classes)).drop(*[f"_m{i}_{k}" for i in range(len(self.members)) for k in ("prediction", "probabilities")])
        return self.last.transform(out).drop(*_meta_names(len(self.members), len(self.classes)))


BASES = ("SVC", "RandomForestClassifier", "GradientBoostingClassifier", "LogisticRegression", "GaussianNB")


def _score_columns(out: DataFrame, model, classes: int) -> DataFrame:
    """One ``_s<class>`` score per class (two classes: only the second): SVM margin, else probability."""
    picked = [1] if classes == 2 else range(classes)
    source = "decision" if "decision" in out.columns else "probabilities"
    new = {f"_s{c}": F.col(source)[0 if source == "decision" and classes == 2 else c] for c in picked}
    return out.withColumns(new).drop("prediction", "probabilities", "class_probabilities", "decision", "_probability")


def _sigmoid(rows, n_pos, n_neg):
    """Logistic fit of the smoothed targets: each row enters once per label, weighted."""
    high, low = (n_pos + 1.0) / (n_pos + 2.0), 1.0 / (n_neg + 2.0)
    share = F.when(F.col("hit") == 1, F.lit(high)).otherwise(F.lit(low))
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), share.alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - share).alias("w"))))
    data = rows.select(array_to_vector(F.array("s")).alias("features"), both.alias("b")).select("features", "b.label", "b.w")
    m = MLLogistic(maxIter=100, weightCol="w", tol=1e-9).fit(for_passes(data, 2 * int(n_pos + n_neg)))
    return {"kind": "sigmoid", "slope": float(m.coefficients[0]), "intercept": float(m.intercept)}


#: Corners of a curve that the model's own state holds; a longer curve stays a table.
CURVE_POINTS = 100_000


def _isotonic(rows):
    """Monotone step fit on counts per distinct score."""
    pools = monotone_pools(rows.select(F.col("s").alias("x"), F.lit(1.0).alias("w"), F.col("hit").alias("t")))
    if 2 * pools.count() > CURVE_POINTS:
        return {"kind": "isotonic_table", "pieces": curve_pieces(pools)}
    corners = [(x, r.t / r.w) for r in pools.orderBy("number").collect() for x in dict.fromkeys((r.lo, r.hi))]
    return {"kind": "isotonic", "x": [c[0] for c in corners], "y": [c[1] for c in corners]}


class CalibratedClassifier(Operator):
    """Per fold: a member fitted on the other folds and a calibrator fitted on the held-out scores; probabilities are
    averaged over the folds."""

    def __init__(self, cols, target, id_col, base="SVC", method="sigmoid", cv=5, seed=42, params=None, parallelism=PARALLEL_FITS):
        super().__init__()
        if base not in BASES:
            raise ValueError(f"base must be one of {BASES}")
        if method not in ("sigmoid", "isotonic"):
            raise ValueError("method must be sigmoid or isotonic")
        self.cols, self.target, self.id_col, self.base, self.method = names(cols), target, id_col, base, method
        self.cv, self.seed, self.member_params, self.parallelism = int(cv), seed, params or {}, parallelism

    def _fit(self, df):
        require(df, [*self.cols, self.target, self.id_col])
        classes = sorted_classes(df, self.target)
        kept = with_folds(df.select(*dict.fromkeys([self.id_col, *self.cols, self.target])), self.id_col, self.cv, self.target, self.seed).persist()
        extra = {"probability": False} if self.base == "SVC" else {}

        def one(fold):
            member = make(self.base, self.cols, self.target, **extra, **self.member_params).fit(folded.where(F.col("_fold") != fold))
            held = _score_columns(member.transform(folded.where(F.col("_fold") == fold)), member, len(classes))
            picked = [1] if len(classes) == 2 else list(range(len(classes)))
            index = class_index(F.col(f"`{self.target}`"), classes)
            held = held.select(index.alias("y"), *[f"_s{c}" for c in picked]).persist()
            curves = []
            for c in picked:
                rows = held.select(F.col(f"_s{c}").alias("s"), F.when(F.col("y") == c, 1.0).otherwise(0.0).alias("hit"))
                n, pos = rows.agg(F.count(F.lit(1)), F.sum("hit")).first()
                curves.append(_sigmoid(rows, pos, n - pos) if self.method == "sigmoid" else _isotonic(rows))
            held.unpersist()
            return member, curves

        try:
            n = kept.count()
            folded = for_passes(kept, n)
            pairs = fit_all([lambda f=f: one(f) for f in range(self.cv)], self.parallelism)
            model = CalibratedModel(
                cols=self.cols, target=self.target, base_estimator=self.base, calibration_method=self.method, cv=self.cv,
                classes=classes, training_samples=n,
            )
            model.members = [p[0] for p in pairs]
            model.hold([p[1] for p in pairs])
            model.state["accuracy"] = accuracy(model, folded, self.target)
        finally:
            kept.unpersist()
        return model


def _curve(score, curve):
    if curve["kind"] == "sigmoid":
        return 1.0 / (1.0 + F.exp(-(score * F.lit(curve["slope"]) + F.lit(curve["intercept"]))))
    x, y = np.array(curve["x"]), np.array(curve["y"])

    @F.pandas_udf("double")
    def step(s: pd.Series) -> pd.Series:
        return pd.Series(np.interp(s.to_numpy(dtype=float), x, y))

    return step(score)


class CalibratedModel(EnsembleModel):
    pieces: dict = {}

    def hold(self, curves):
        """Short curves are part of the state, long ones tables named by fold and place."""
        self.pieces = {f"{f}_{i}": checkpointed(c.pop("pieces")) for f, fold in enumerate(curves) for i, c in enumerate(fold) if "pieces" in c}
        self.state["curves"] = curves

    def tables(self):
        return self.pieces

    def attach(self, parts, tables):
        super().attach(parts, tables)
        self.pieces = tables

    def _transform(self, df):
        k = len(self.classes)
        picked = [1] if k == 2 else list(range(k))
        out, per_fold = df, []
        for f, (m, curves) in enumerate(zip(self.members, self.curves)):
            out = _score_columns(m.transform(out), m, k)
            for i, (c, curve) in enumerate(zip(picked, curves)):
                if curve["kind"] == "isotonic_table":
                    out = interpolated(out, f"_s{c}", self.pieces[f"{f}_{i}"], f"_c{f}_{c}")
                else:
                    out = out.withColumn(f"_c{f}_{c}", _curve(F.col(f"_s{c}"), curve))
            out = out.drop(*[f"_s{c}" for c in picked])
            ps = [F.col(f"_c{f}_{c}") for c in picked]
            if k == 2:
                ps = [1.0 - ps[0], ps[0]]
            else:
                whole = sum(ps[1:], ps[0])
                ps = [F.when(whole > 0, p / whole).otherwise(F.lit(1.0 / k)) for p in ps]
            per_fold.append(ps)
        mean = [sum((ps[i] for ps in per_fold[1:]), per_fold[0][i]) / len(per_fold) for i in range(k)]
        out = out.withColumn("calibrated_probabilities", F.array(*mean)).drop(*[f"_c{f}_{c}" for f in range(len(per_fold)) for c in picked])
        best = F.array_position("calibrated_probabilities", F.array_max("calibrated_probabilities")) - 1
        return out.withColumn("prediction", class_value(best, self.classes))

"""Preprocessing steps and an optional final estimator as one operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..core import Fitted, Operator
from ..functions.columns import names, require
from .decompose import PCA
from .metrics import classification_metrics, regression_metrics
from .polynomial import PolynomialFeatures
from .registry import is_regressor, make
from .scalers import MinMaxScaler, RobustScaler, StandardScaler, normalizer

STEPS = ("StandardScaler", "MinMaxScaler", "RobustScaler", "Normalizer", "PCA", "PolynomialFeatures")
ESTIMATORS = (
    "LogisticRegression", "RandomForestClassifier", "RandomForestRegressor", "LinearRegression", "SVC", "SVR",
    "GradientBoostingClassifier", "GradientBoostingRegressor",
)


class _Normalize(Operator):
    def __init__(self, cols):
        super().__init__()
        self.cols = cols

    def _fit(self, df):
        return NormalizeModel(cols=self.cols)


class NormalizeModel(Fitted):
    def _transform(self, df):
        return normalizer(df, self.cols)


def _step(name, cols, pca_components, degree):
    if name == "StandardScaler":
        return StandardScaler(cols)
    if name == "MinMaxScaler":
        return MinMaxScaler(cols)
    if name == "RobustScaler":
        return RobustScaler(cols)
    if name == "Normalizer":
        return _Normalize(cols)
    if name == "PCA":
        return PCA(cols, pca_components)
    if name == "PolynomialFeatures":
        return PolynomialFeatures(cols, degree)
    raise ValueError(f"step must be one of {STEPS}")


class Chain(Operator):
    """Fit each step on the output of the one before, then the estimator."""

    def __init__(self, cols, preprocessors, estimator="none", target=None, pca_components=2, degree=2, params=None):
        super().__init__()
        if estimator not in (*ESTIMATORS, "none"):
            raise ValueError(f"estimator must be one of {ESTIMATORS} or none")
        if estimator != "none" and target is None:
            raise ValueError("an estimator needs a target")
        self.cols, self.preprocessors, self.estimator, self.target = names(cols), list(preprocessors), estimator, target
        self.pca_components, self.degree, self.member_params = pca_components, degree, params or {}

    def _fit(self, df):
        require(df, self.cols + ([self.target] if self.target else []))
        rows, cols, stages, outputs = df, self.cols, [], []
        for i, name in enumerate(self.preprocessors):
            fitted = _step(name, cols, self.pca_components, self.degree).fit(rows)
            stages.append(fitted)
            rows, cols = _apply(rows, fitted, i)
            outputs.append(cols)
        model = ChainModel(
            cols=self.cols, target=self.target, steps=[*self.preprocessors, *([self.estimator] if self.estimator != "none" else [])],
            has_estimator=self.estimator != "none", stages=[s.to_json() for s in stages], last=None, score=None,
        )
        if self.estimator != "none":
            model.estimator = make(self.estimator, cols, self.target, **self.member_params).fit(rows)
            scored = model.transform(df)
            if is_regressor(self.estimator):
                model.state["score"] = regression_metrics(scored, self.target, "prediction").first().r2
            else:
                model.state["score"] = classification_metrics(scored, self.target, "prediction").first().accuracy
        return model


def _apply(rows, fitted, i):
    """Run one step and give its outputs names no other step uses."""
    before = rows.columns
    out = fitted.transform(rows)
    made = _outputs(fitted)
    renamed = [f"_t{i}_{j}" for j in range(len(made))]
    kept = [F.col(f"`{c}`") for c in before]
    return out.select(*kept, *[F.col(f"`{m}`").alias(r) for m, r in zip(made, renamed)]), renamed


def _outputs(fitted) -> list[str]:
    kind = type(fitted).__name__
    if kind in ("StandardScalerModel", "MinMaxScalerModel"):
        return [f"{fitted.output_prefix}{c}" for c in fitted.cols]
    if kind == "RobustScalerModel":
        return [f"{c}_scaled" for c in fitted.cols]
    if kind == "NormalizeModel":
        return [f"{c}_normalized" for c in fitted.cols]
    if kind == "PCAModel":
        return [f"PC{i + 1}" for i in range(fitted.n_components)]
    return fitted.feature_names()


class ChainModel(Fitted):
    estimator: Fitted = None

    def parts(self):
        return {"estimator": self.estimator} if self.estimator is not None else {}

    def attach(self, parts, tables):
        self.estimator = parts.get("estimator")

    def to_json(self):
        if self.estimator is not None:
            self.state["last"] = self.estimator.to_json()
        return super().to_json()

    def _steps(self, df):
        rows, cols, made = df, self.cols, []
        for i, text in enumerate(self.stages):
            rows, cols = _apply(rows, Fitted.from_json(text), i)
            made += cols
        return rows, cols, made

    def _transform(self, df):
        """prediction (+ probabilities); without an estimator the transformed columns."""
        if not self.has_estimator:
            return self.transformed(df)
        if self.estimator is None:
            self.estimator = Fitted.from_json(self.state["last"])
        rows, _, made = self._steps(df)
        return self.estimator.transform(rows).drop(*made)

    def transformed(self, df):
        """``transformed_1..n``: the output of the last preprocessing step."""
        rows, cols, made = self._steps(df)
        for i, c in enumerate(cols):
            rows = rows.withColumn(f"transformed_{i + 1}", F.col(f"`{c}`").cast("double"))
        return rows.drop(*made)

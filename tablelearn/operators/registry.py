"""Estimators by name, for ensembles, model selection and chains."""

from __future__ import annotations

from ..core import Operator
from .bayes import BernoulliNB, GaussianNB, MultinomialNB
from .knn import KNNClassifier, KNNRegressor
from .linear import ElasticNet, Lasso, LinearRegression, LogisticRegression, Ridge
from .svm import SVC, SVR
from .trees import (
    DecisionTreeClassifier, DecisionTreeRegressor, GradientBoostingClassifier, GradientBoostingRegressor,
    RandomForestClassifier, RandomForestRegressor,
)

REGRESSORS = {
    "LinearRegression": LinearRegression, "Ridge": Ridge, "Lasso": Lasso, "ElasticNet": ElasticNet,
    "DecisionTreeRegressor": DecisionTreeRegressor, "RandomForestRegressor": RandomForestRegressor,
    "GradientBoostingRegressor": GradientBoostingRegressor, "SVR": SVR, "KNeighborsRegressor": KNNRegressor,
}
CLASSIFIERS = {
    "LogisticRegression": LogisticRegression, "DecisionTreeClassifier": DecisionTreeClassifier,
    "RandomForestClassifier": RandomForestClassifier, "GradientBoostingClassifier": GradientBoostingClassifier,
    "SVC": SVC, "KNeighborsClassifier": KNNClassifier, "GaussianNB": GaussianNB,
    "MultinomialNB": MultinomialNB, "BernoulliNB": BernoulliNB,
}
NEEDS_ID = ("KNeighborsRegressor", "KNeighborsClassifier")
ALIASES = {"n_neighbors": "k"}


def is_regressor(name: str) -> bool:
    return name in REGRESSORS


def make(name: str, cols, target: str, id_col: str | None = None, **params) -> Operator:
    kind = REGRESSORS.get(name) or CLASSIFIERS.get(name)
    if kind is None:
        raise ValueError(f"unknown model {name}; use one of {[*REGRESSORS, *CLASSIFIERS]}")
    params = {ALIASES.get(k, k): v for k, v in params.items()}
    if name in NEEDS_ID:
        if id_col is None:
            raise ValueError(f"{name} needs id_col")
        params["id_col"] = id_col
    elif name not in ("LinearRegression", "Ridge", "Lasso", "ElasticNet"):
        params.setdefault("with_score", False)
    return kind(cols, target, **params)

"""Monomials up to a degree, ordered by degree and then by column combination."""

from __future__ import annotations

from functools import reduce
from itertools import combinations, combinations_with_replacement

from pyspark.sql import functions as F

from ..core import Fitted, Operator, with_columns
from ..functions.columns import as_double, names, require


def monomials(n: int, degree: int, include_bias: bool, interaction_only: bool) -> list[tuple[int, ...]]:
    pick = combinations if interaction_only else combinations_with_replacement
    first = 0 if include_bias else 1
    return [m for d in range(first, degree + 1) for m in pick(range(n), d)]


def monomial_name(cols: list[str], m: tuple[int, ...]) -> str:
    powers = [(cols[i], m.count(i)) for i in sorted(set(m))]
    return " ".join(c if p == 1 else f"{c}^{p}" for c, p in powers) or "1"


class PolynomialFeatures(Operator):
    def __init__(self, cols, degree=2, include_bias=True, interaction_only=False):
        super().__init__()
        self.cols, self.degree = names(cols), int(degree)
        self.include_bias, self.interaction_only = include_bias, interaction_only

    def _fit(self, df):
        require(df, self.cols)
        return PolynomialFeaturesModel(
            cols=self.cols, degree=self.degree, include_bias=self.include_bias, interaction_only=self.interaction_only,
        )


class PolynomialFeaturesModel(Fitted):
    def feature_names(self) -> list[str]:
        return [monomial_name(self.cols, m) for m in self._terms()]

    def _terms(self):
        return monomials(len(self.cols), self.degree, self.include_bias, self.interaction_only)

    def _transform(self, df):
        require(df, self.cols)
        xs = [as_double(df, c) for c in self.cols]
        new = {}
        for m in self._terms():
            new[monomial_name(self.cols, m)] = reduce(lambda a, b: a * b, [xs[i] for i in m]) if m else F.lit(1.0)
        return with_columns(df, new)

"""Scalers, normalizer and binarizer. Fits are one aggregate pass over all columns; transforms are projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..core import Fitted, Operator, with_columns
from ..functions.columns import as_double, as_matrix_columns, names, require
from ..plans.quantiles import exact_quantiles

QUANTILE_RANGES = {"25-75": (0.25, 0.75), "10-90": (0.10, 0.90), "5-95": (0.05, 0.95)}


def _aggregate(df: DataFrame, cols: list[str], on_null: str, **aggs):
    """One job: every statistic of every column. Returns ({stat: [per column]}, row count)."""
    data = as_matrix_columns(df, cols, on_null)
    exprs = [fn(F.col(f"`{c}`")).alias(f"{stat}_{i}") for stat, fn in aggs.items() for i, c in enumerate(cols)]
    row = data.agg(F.count(F.lit(1)).alias("n"), *exprs).first()
    if row["n"] == 0:
        raise ValueError("no rows to fit on")
    return {stat: [row[f"{stat}_{i}"] for i in range(len(cols))] for stat in aggs}, row["n"]


def _nonzero(values):
    return [float(v) if v else 1.0 for v in values]


class StandardScaler(Operator):
    """(x - mean) / population standard deviation; a constant column has scale 1."""

    def __init__(self, cols, with_mean=True, with_std=True, output_prefix="scaled_", on_null="error"):
        super().__init__()
        self.cols, self.with_mean, self.with_std = names(cols), with_mean, with_std
        self.output_prefix, self.on_null = output_prefix, on_null

    def _fit(self, df):
        stats, n = _aggregate(df, self.cols, self.on_null, mean=F.avg, variance=F.var_pop)
        return StandardScalerModel(
            cols=self.cols, mean=stats["mean"], variance=stats["variance"],
            scale=_nonzero([v**0.5 for v in stats["variance"]]), with_mean=self.with_mean, with_std=self.with_std,
            output_prefix=self.output_prefix, fitted_samples=n,
        )


class StandardScalerModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        new = {}
        for c, m, s in zip(self.cols, self.mean, self.scale):
            x = as_double(df, c)
            x = x - F.lit(m) if self.with_mean else x
            new[f"{self.output_prefix}{c}"] = x / F.lit(s) if self.with_std else x
        return with_columns(df, new)


class MinMaxScaler(Operator):
    """x * scale + min onto ``range``; a constant column divides by 1. No clipping."""

    def __init__(self, cols, range=(0.0, 1.0), output_prefix="scaled_", on_null="error"):
        super().__init__()
        self.cols, self.range = names(cols), tuple(float(v) for v in range)
        if self.range[0] >= self.range[1]:
            raise ValueError("range minimum must be below its maximum")
        self.output_prefix, self.on_null = output_prefix, on_null

    def _fit(self, df):
        stats, n = _aggregate(df, self.cols, self.on_null, lo=F.min, hi=F.max)
        lo, hi = self.range
        spans = [b - a for a, b in zip(stats["lo"], stats["hi"])]
        scale = [(hi - lo) / s for s in _nonzero(spans)]
        return MinMaxScalerModel(
            cols=self.cols, data_min=stats["lo"], data_max=stats["hi"], data_range=spans, scale=scale,
            min=[lo - a * s for a, s in zip(stats["lo"], scale)], output_prefix=self.output_prefix, fitted_samples=n,
        )


class MinMaxScalerModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        return with_columns(df, {
            f"{self.output_prefix}{c}": as_double(df, c) * F.lit(s) + F.lit(m)
            for c, s, m in zip(self.cols, self.scale, self.min)
        })

    def inverse_transform(self, df, cols=None):
        """``original_<col>`` = (x - min) / scale, read from ``cols`` (default: the scaled columns)."""
        cols = names(cols) if cols else [f"{self.output_prefix}{c}" for c in self.cols]
        require(df, cols)
        return with_columns(df, {
            f"original_{c}": (as_double(df, src) - F.lit(m)) / F.lit(s)
            for src, c, s, m in zip(cols, self.cols, self.scale, self.min)
        })


class RobustScaler(Operator):
    """(x - median) / (upper - lower quantile), linear-interpolated quantiles.

    ``accuracy=None`` gives exact quantiles: ``percentile`` merges a value->count map, so its state is the number of
    distinct values. For continuous columns at scale, ``accuracy`` (e.g. 10000) switches to the bounded
    ``percentile_approx`` sketch with rank error 1/accuracy.
    """

    def __init__(self, cols, centering=True, scaling=True, quantiles="25-75", accuracy=None, on_null="error"):
        super().__init__()
        if quantiles not in QUANTILE_RANGES:
            raise ValueError(f"quantiles must be one of {sorted(QUANTILE_RANGES)}")
        self.cols, self.centering, self.scaling = names(cols), centering, scaling
        self.quantiles, self.accuracy, self.on_null = quantiles, accuracy, on_null

    def _fit(self, df):
        lo, hi = QUANTILE_RANGES[self.quantiles]
        if self.accuracy is None:
            data = as_matrix_columns(df, self.cols, self.on_null)
            found, n = exact_quantiles(data, self.cols, [lo, 0.5, hi])
        else:
            marks = F.array(F.lit(lo), F.lit(0.5), F.lit(hi))
            stats, n = _aggregate(
                df, self.cols, self.on_null, q=lambda c: F.percentile_approx(c, marks, self.accuracy)
            )
            found = stats["q"]
        return RobustScalerModel(
            cols=self.cols, center=[float(q[1]) for q in found], scale=_nonzero([q[2] - q[0] for q in found]),
            centering=self.centering, scaling=self.scaling, quantiles=self.quantiles, fitted_samples=n,
        )


class RobustScalerModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        new = {}
        for c, m, s in zip(self.cols, self.center, self.scale):
            x = as_double(df, c)
            x = x - F.lit(m) if self.centering else x
            new[f"{c}_scaled"] = x / F.lit(s) if self.scaling else x
        return with_columns(df, new)

    def inverse_transform(self, df, cols=None):
        cols = names(cols) if cols else [f"{c}_scaled" for c in self.cols]
        require(df, cols)
        new = {}
        for src, c, m, s in zip(cols, self.cols, self.center, self.scale):
            x = as_double(df, src)
            x = x * F.lit(s) if self.scaling else x
            new[f"{c}_original"] = x + F.lit(m) if self.centering else x
        return with_columns(df, new)


def normalizer(df: DataFrame, cols, norm="l2") -> DataFrame:
    """Divide each row by its l1, l2 or max norm; a zero row is unchanged."""
    cols = names(cols)
    require(df, cols)
    xs = [as_double(df, c) for c in cols]
    if norm == "l2":
        size = F.sqrt(sum((x * x for x in xs[1:]), xs[0] * xs[0]))
    elif norm == "l1":
        size = sum((F.abs(x) for x in xs[1:]), F.abs(xs[0]))
    elif norm == "max":
        size = F.abs(xs[0]) if len(xs) == 1 else F.greatest(*[F.abs(x) for x in xs])
    else:
        raise ValueError("norm must be l1, l2 or max")
    safe = F.when(size == 0, F.lit(1.0)).otherwise(size)
    return with_columns(df, {f"{c}_normalized": x / safe for c, x in zip(cols, xs)})


def binarizer(df: DataFrame, cols, threshold=0.0) -> DataFrame:
    """1.0 where the value is strictly above the threshold, else 0.0."""
    cols = names(cols)
    require(df, cols)
    return with_columns(df, {
        f"{c}_binary": F.when(as_double(df, c) > F.lit(float(threshold)), 1.0).otherwise(0.0) for c in cols
    })

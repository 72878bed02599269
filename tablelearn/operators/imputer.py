"""Fill missing values in place with a per-column statistic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..core import Fitted, Operator, with_columns
from ..functions.columns import as_double, names, require
from ..plans.quantiles import exact_quantiles

STRATEGIES = ("mean", "median", "most_frequent", "constant")


def _present(df: DataFrame, c: str, numeric: bool):
    """The value with empty text and NaN turned into null."""
    raw = F.col(f"`{c}`")
    kind = df.schema[c].dataType
    if isinstance(kind, T.StringType):
        filled = F.when(raw != "", raw)
        if not numeric:
            return filled
        parsed = filled.try_cast("double")
        bad = F.raise_error(F.concat(F.lit(f"not a number in column {c}: "), raw)).cast("double")
        return F.when(filled.isNotNull() & parsed.isNull(), bad).otherwise(parsed)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        raw = F.when(~F.isnan(raw), raw)
    return as_double(df, c) if numeric and not isinstance(kind, (T.DoubleType, T.FloatType)) else raw


class SimpleImputer(Operator):
    def __init__(self, cols, strategy="mean", fill_value=None):
        super().__init__()
        if strategy not in STRATEGIES:
            raise ValueError(f"strategy must be one of {STRATEGIES}")
        self.cols, self.strategy, self.fill_value = names(cols), strategy, fill_value

    def _fit(self, df):
        require(df, self.cols)
        numeric = self.strategy in ("mean", "median")
        data = df.select(*[_present(df, c, numeric).alias(c) for c in self.cols])
        if self.strategy == "constant":
            stats = [_number_like(self.fill_value)] * len(self.cols)
        elif self.strategy == "mean":
            row = data.agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(self.cols)]).first()
            stats = list(row)
        elif self.strategy == "median":
            found, _ = exact_quantiles(data, self.cols, [0.5])
            stats = [q[0] if q else None for q in found]
        else:
            stats = [self._mode(data, c) for c in self.cols]
        if any(s is None for s in stats):
            raise ValueError("a column has no value to take the statistic from")
        return SimpleImputerModel(cols=self.cols, strategy=self.strategy, statistics=stats)

    @staticmethod
    def _mode(data, c):
        """Most frequent value, the smallest one on a tie: count per value, then one struct minimum."""
        row = (
            data.where(F.col(f"`{c}`").isNotNull()).groupBy(F.col(f"`{c}`").alias("v")).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("v"))).alias("best")).first()
        )
        return row.best.v if row.best is not None else None


def _number_like(value):
    if isinstance(value, str):
        try:
            return float(value)
        except ValueError:
            return value
    return value


class SimpleImputerModel(Fitted):
    def statistics_map(self) -> dict:
        return dict(zip(self.cols, self.statistics))

    def _transform(self, df):
        require(df, self.cols)
        numeric = self.strategy in ("mean", "median")
        new = {}
        for c, fill in zip(self.cols, self.statistics):
            kind = T.DoubleType() if numeric else df.schema[c].dataType
            new[c] = F.coalesce(_present(df, c, numeric), F.lit(fill).cast(kind))
        order = [new[c].alias(c) if c in new else F.col(f"`{c}`") for c in df.columns]
        return df.select(*order)

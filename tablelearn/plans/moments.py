"""Means and centred cross-products of a set of columns, optionally per group, in one pass over the rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WELFORD_COLUMNS = 4
JVM_COLUMNS = 12


@dataclass
class Moments:
    """n rows, mean vector and S = sum (x - mean)(x - mean)'. Moments of disjoint row sets add and subtract."""

    n: int
    mean: np.ndarray
    cross: np.ndarray

    @staticmethod
    def zero(d: int) -> "Moments":
        return Moments(0, np.zeros(d), np.zeros((d, d)))

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return other if not self.n else self
        gap = other.mean - self.mean
        return Moments(
            n, self.mean + gap * other.n / n, self.cross + other.cross + np.outer(gap, gap) * self.n * other.n / n
        )

    def raw_cross(self) -> np.ndarray:
        """sum x x' (not centred)."""
        return self.cross + self.n * np.outer(self.mean, self.mean)


def moments(data: DataFrame, cols: list[str]) -> Moments:
    return moments_by(data, cols, F.lit(0)).get(0, Moments.zero(len(cols)))


def moments_by(data: DataFrame, cols: list[str], group: Column) -> dict:
    """{group: Moments}. The group count must be small (folds, classes).

    Up to WELFORD_COLUMNS columns: Spark's own covariance aggregates. Up to JVM_COLUMNS: plain sums inside
    whole-stage codegen. More: one d x d product per Arrow batch, summed by entry, so the driver sees d(d+1)/2
    numbers per group whatever the row or partition count. Sums are taken around the columns' means, from a first
    narrow aggregate, which keeps large offsets from cancelling.
    """
    d = len(cols)
    if d <= WELFORD_COLUMNS:
        return _by_covariance(data, cols, group)
    probe = data.select(*[F.col(f"`{c}`") for c in cols]).agg(*[F.avg(f"`{c}`") for c in cols]).first()
    shift = np.array([float(v) if v is not None else 0.0 for v in probe])
    rows = data.select(group.alias("_g"), *[(F.col(f"`{c}`") - F.lit(float(s))).alias(f"x{i}") for i, (c, s) in enumerate(zip(cols, shift))])
    out = {}
    if d <= JVM_COLUMNS:
        aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(f"x{i}").alias(f"s{i}") for i in range(d)]
        aggs += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
        for row in rows.groupBy("_g").agg(*aggs).collect():
            first = np.array([row[f"s{i}"] for i in range(d)])
            second = np.zeros((d, d))
            for i in range(d):
                for j in range(i, d):
                    second[i, j] = second[j, i] = row[f"p{i}_{j}"]
            out[row["_g"]] = _centre(row["n"], first, second, shift)
        return out
    upper = np.triu_indices(d)
    width = 1 + d + len(upper[0])

    def partial(batches):
        totals, kind = {}, None
        for batch in batches:
            kind = batch.schema.field(0).type
            keys = np.array(batch.column(0).to_pylist(), dtype=object)
            x = np.column_stack([batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(d)])
            for key in set(keys):
                part = x[keys == key]
                sums = np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part)[upper]])
                totals[key] = totals.get(key, 0.0) + sums
        for key, sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * width, kind), pa.array(np.arange(width, dtype=np.int32)), pa.array(sums)], names=["g", "pos", "v"]
            )

    kind = rows.schema["_g"].dataType.simpleString()
    summed = rows.mapInArrow(partial, f"g {kind}, pos int, v double").groupBy("g", "pos").agg(F.sum("v").alias("v")).collect()
    packed = {}
    for row in summed:
        packed.setdefault(row.g, np.zeros(width))[row.pos] = row.v
    for key, sums in packed.items():
        second = np.zeros((d, d))
        second[upper] = sums[1 + d:]
        second = second + np.triu(second, 1).T
        out[key] = _centre(int(sums[0]), sums[1 : 1 + d], second, shift)
    return out


def _by_covariance(data, cols, group) -> dict:
    x = [F.col(f"`{c}`") for c in cols]
    d = len(cols)
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(x[i]).alias(f"m{i}") for i in range(d)]
    aggs += [(F.var_pop(x[i]) if i == j else F.covar_pop(x[i], x[j])).alias(f"p{i}_{j}") for i in range(d) for j in range(i, d)]
    out = {}
    for row in data.groupBy(group.alias("_g")).agg(*aggs).collect():
        cross = np.array([[row[f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)], dtype=float)
        out[row["_g"]] = Moments(row["n"], np.array([row[f"m{i}"] for i in range(d)], dtype=float), cross * row["n"])
    return out


def _centre(n, first, second, shift) -> Moments:
    offset = first / n
    return Moments(int(n), shift + offset, second - n * np.outer(offset, offset))

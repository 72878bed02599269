"""Isolation forest: a bounded sample per tree, trees grown side by side, rows scored where they are."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..core import Fitted, Operator
from ..functions.columns import feature_array, names, require
from ..plans.lineage import checkpointed
from ..plans.quantiles import exact_quantiles

SAMPLE_ROWS = 256
EULER_GAMMA = 0.5772156649015329


def average_path(n: float) -> float:
    """Expected path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def grow(x: np.ndarray, limit: int, rng: np.random.Generator) -> list[tuple[int, float, int, int, float]]:
    """Nodes (feature, threshold, left, right, path length at a leaf); feature -1 marks a leaf."""
    nodes: list = [None]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        at, rows, depth = todo.pop()
        part = x[rows]
        spread = part.max(axis=0) - part.min(axis=0)
        if depth >= limit or len(rows) <= 1 or not spread.any():
            nodes[at] = (-1, 0.0, -1, -1, depth + average_path(len(rows)))
            continue
        f = int(rng.choice(np.flatnonzero(spread > 0)))
        cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
        left = part[:, f] <= cut
        a, b = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[at] = (f, cut, a, b, 0.0)
        todo += [(a, rows[left], depth + 1), (b, rows[~left], depth + 1)]
    return nodes


def path_lengths(x: np.ndarray, trees: list) -> np.ndarray:
    """Mean path length of each row over the forest."""
    out = np.zeros(len(x))
    every = np.arange(len(x))
    for feature, cut, left, right, length in trees:
        at = np.zeros(len(x), dtype=int)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            go = np.where(x[every, np.maximum(f, 0)] <= cut[at], left[at], right[at])
            at = np.where(inner, go, at)
        out += length[at]
    return out / len(trees)


class IsolationForest(Operator):
    def __init__(self, cols, id_col, n_estimators=100, contamination=0.1, seed=42):
        super().__init__()
        if not 0 < contamination <= 0.5:
            raise ValueError("contamination must be in (0, 0.5]")
        self.cols, self.id_col, self.trees, self.contamination, self.seed = names(cols), id_col, int(n_estimators), float(contamination), seed

    def _fit(self, df):
        require(df, [*self.cols, self.id_col])
        rows = df.select(F.col(f"`{self.id_col}`").cast("string").alias("id"), feature_array(df, self.cols).alias("x"))
        n = rows.count()
        if n == 0:
            raise ValueError("no rows to fit on")
        size, seed, trees = min(SAMPLE_ROWS, n), self.seed, self.trees
        limit = math.ceil(math.log2(max(size, 2)))
        # one hash-thresholded draw of a bounded size feeds all trees. Each drawn row is dealt by hash to as many trees as
        # give every tree about four samples' rows (all trees, if there are few rows); a tree takes its first rows of these
        share = min(1.0, 4.0 * size * trees / n)
        draw = rows
        if share < 1.0:
            draw = rows.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000_007)) < F.lit(int(share * 1_000_000_007)))
        draw = checkpointed(draw)
        copies = min(trees, math.ceil(4.0 * size * trees / max(1, draw.count())))
        start = F.pmod(F.xxhash64("id", F.lit(f"deal {seed}")), F.lit(trees))
        dealt = draw.withColumn("tree", F.explode(F.sequence(start, start + F.lit(copies - 1))))
        dealt = dealt.withColumn("tree", F.pmod("tree", F.lit(trees)).cast("int"))
        dealt = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.xxhash64("id", "tree", F.lit(seed)), "id")))
        dealt = dealt.where(F.col("rank") <= size).drop("rank")

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            pdf = pdf.sort_values("id")
            nodes = grow(np.stack(pdf["x"].to_numpy()), limit, np.random.default_rng([seed, tree]))
            out = pd.DataFrame(nodes, columns=["feature", "cut", "lo", "hi", "length"])
            out.insert(0, "node", np.arange(len(out)))
            out.insert(0, "tree", tree)
            return out

        grown = dealt.groupBy("tree").applyInPandas(build, "tree int, node int, feature int, cut double, lo int, hi int, length double").collect()
        forest = [[] for _ in range(trees)]
        for r in sorted(grown, key=lambda r: (r.tree, r.node)):
            forest[r.tree].append([r.feature, r.cut, r.lo, r.hi, r.length])
        model = IsolationForestModel(
            cols=self.cols, forest=forest, sample_rows=size, offset=0.0, contamination=self.contamination, n_estimators=trees,
            training_samples=n,
        )
        scored = checkpointed(model.transform(df).select("anomaly_score"))
        found, _ = exact_quantiles(scored, ["anomaly_score"], [self.contamination])
        model.state["offset"] = float(found[0][0])
        outliers = scored.where(F.col("anomaly_score") - F.lit(model.offset) < 0).count()
        model.state.update(n_outliers=outliers, n_inliers=n - outliers)
        return model


class IsolationForestModel(Fitted):
    def _transform(self, df: DataFrame) -> DataFrame:
        """``anomaly_score`` = shifted negative score (below 0 = anomaly) and ``is_anomaly``."""
        require(df, self.cols)
        trees = []
        for nodes in self.forest:
            f, cut, lo, hi, length = zip(*nodes)
            trees.append((np.array(f), np.array(cut), np.array(lo), np.array(hi), np.array(length)))
        usual = average_path(self.sample_rows) or 1.0
        offset = self.offset

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            return pd.Series(-(2.0 ** (-path_lengths(np.stack(x.to_numpy()), trees) / usual)))

        out = df.withColumn("anomaly_score", score(feature_array(df, self.cols)) - F.lit(offset))
        return out.withColumn("is_anomaly", F.col("anomaly_score") < 0)

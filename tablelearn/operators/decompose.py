"""PCA, truncated SVD and non-negative factorisation. Rows never leave the executors; the driver sees d x d or k x d."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..core import Fitted, Operator, with_columns
from ..functions.columns import as_double, as_matrix_columns, feature_array, linear, names, require
from ..plans.lineage import checkpointed
from ..plans.moments import moments
from ..plans.skew import hot_safe_join
from ..plans.sparse import SENT_NUMBERS, batch_arrays, collected_basis, leading_directions, products, sparse_entries
from ..plans.sums import lists_to_matrix, sum_vectors


def _signed(vectors: np.ndarray) -> np.ndarray:
    """Rows flipped so that the entry of largest size is positive."""
    at = np.abs(vectors).argmax(axis=1)
    return vectors * np.where(vectors[np.arange(len(vectors)), at] < 0, -1.0, 1.0)[:, None]


def _eigen(matrix: np.ndarray, k: int):
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    return np.maximum(values[order], 0.0), _signed(vectors[:, order].T)


class PCA(Operator):
    """Principal components of the centred columns. ``n_components=0`` keeps all; clamped to min(rows, columns)."""

    def __init__(self, cols, n_components=2, on_null="error"):
        super().__init__()
        self.cols, self.n_components, self.on_null = names(cols), int(n_components), on_null

    def _fit(self, df):
        m = moments(as_matrix_columns(df, self.cols, self.on_null), self.cols)
        if m.n < 2:
            raise ValueError("need at least two rows")
        top = min(m.n, len(self.cols))
        k = top if self.n_components == 0 else min(self.n_components, top)
        cov = m.cross / (m.n - 1)
        values, vectors = _eigen(cov, k)
        ratio = values / np.trace(cov) if np.trace(cov) > 0 else np.zeros(k)
        return PCAModel(
            cols=self.cols, n_components=k, mean=m.mean.tolist(), components=vectors.tolist(),
            explained_variance=values.tolist(), explained_variance_ratio=ratio.tolist(),
            cumulative_variance_ratio=np.cumsum(ratio).tolist(), fitted_samples=m.n,
        )


class PCAModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        centred = [as_double(df, c) - F.lit(float(m)) for c, m in zip(self.cols, self.mean)]
        return with_columns(df, {f"PC{i + 1}": linear(centred, v) for i, v in enumerate(self.components)})

    def inverse_transform(self, df, cols=None):
        """``reconstructed_<col>`` from the score columns."""
        cols = names(cols) if cols else [f"PC{i + 1}" for i in range(self.n_components)]
        require(df, cols)
        scores = [as_double(df, c) for c in cols]
        return with_columns(df, {
            f"reconstructed_{c}": linear(scores, [v[j] for v in self.components], self.mean[j]) for j, c in enumerate(self.cols)
        })


class TruncatedSVD(Operator):
    """Leading right singular vectors of the uncentred columns. Both algorithm names give the same result here."""

    def __init__(self, cols, n_components=2, algorithm="randomized", seed=42):
        super().__init__()
        if algorithm not in ("randomized", "arpack"):
            raise ValueError("algorithm must be randomized or arpack")
        self.cols, self.n_components = names(cols), int(n_components)

    def _fit(self, df):
        m = moments(as_matrix_columns(df, self.cols), self.cols)
        k = min(self.n_components, len(self.cols))
        squares, vectors = _eigen(m.raw_cross(), k)
        cov = m.cross / m.n
        variance = np.einsum("ij,jk,ik->i", vectors, cov, vectors)
        return TruncatedSVDModel(
            cols=self.cols, components=vectors.tolist(), singular_values=np.sqrt(squares).tolist(),
            explained_variance=variance.tolist(), explained_variance_ratio=(variance / np.trace(cov)).tolist(),
            fitted_samples=m.n,
        )


class TruncatedSVDModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        xs = [as_double(df, c) for c in self.cols]
        return with_columns(df, {f"svd_component_{i + 1}": linear(xs, v) for i, v in enumerate(self.components)})


class SparseTruncatedSVD(Operator):
    """Truncated SVD of one wide sparse column: a vector, an array, or a map from column number to value. A null row is
    a row of zeros, a null value inside is an error. At most the rank many components come back; signs as in
    ``TruncatedSVD``. ``extra`` vectors beyond the wanted ones speed up the passes, of which there are at most ``max_iter``."""

    def __init__(self, col, n_components=2, extra=10, max_iter=30, tol=1e-9, seed=42):
        super().__init__()
        self.col, self.n_components, self.extra = col, int(n_components), int(extra)
        self.max_iter, self.tol, self.seed = int(max_iter), float(tol), seed

    def _fit(self, df):
        require(df, [self.col])
        rows = checkpointed(_sparse_rows(df, self.col))  # what makes the rows runs once, not once for every statistic
        n = rows.count()
        axes, sizes, rounds = leading_directions(rows, self.n_components, self.extra, self.seed, self.max_iter, self.tol)
        k = len(sizes)
        entries = rows.select(F.explode(F.arrays_zip("index", "value")).alias("e")).select(F.col("e.index").alias("col"), F.col("e.value").alias("x"))
        # squares per row and column first, as equal indices of a row add up
        squares = rows.select(F.aggregate(_merged(F.col("index"), F.col("value")), F.lit(0.0), lambda a, v: a + v * v).alias("s"))
        means = entries.groupBy("col").agg((F.sum("x") / max(n, 1)).alias("m"))
        spread = (squares.agg(F.sum("s")).first()[0] or 0.0) / max(n, 1) - (means.agg(F.sum(F.col("m") * F.col("m"))).first()[0] or 0.0)
        if k:
            lengths = [F.max_by(F.col("v")[j], F.struct(F.abs(F.col("v")[j]), -F.col("col"))).alias(f"v{j}") for j in range(k)]
            sign = [-1.0 if v < 0 else 1.0 for v in axes.agg(*lengths).first()]
            axes = checkpointed(axes.select("col", F.array(*[F.col("v")[j] * F.lit(sign[j]) for j in range(k)]).alias("v")))
            centre = axes.join(means, "col").agg(*[F.sum(F.col("v")[j] * F.col("m")) for j in range(k)]).first()
        variance = [float(s * s / n - m * m) for s, m in zip(sizes, centre)] if k else []
        model = SparseTruncatedSVDModel(
            col=self.col, n_components=k, singular_values=[float(s) for s in sizes], rounds=rounds, fitted_samples=n, columns=axes.count(),
            explained_variance=variance, explained_variance_ratio=[v / spread if spread > 0 else 0.0 for v in variance],
        )
        model.axes = axes
        return model


def _sparse_rows(df, name):
    index, value = sparse_entries(df, name)
    bad = F.exists(value, lambda v: v.isNull())
    value = F.when(bad, F.raise_error(F.lit(f"missing value in column {name}")).cast("array<double>")).otherwise(value)
    none = F.col(f"`{name}`").isNull()
    return df.select(
        F.when(none, F.array().cast("array<long>")).otherwise(index).alias("index"), F.when(none, F.array().cast("array<double>")).otherwise(value).alias("value")
    )


def _merged(index, value):
    """The values of a row, equal indices added up."""
    pairs = F.arrays_zip(index.alias("index"), value.alias("value"))
    alone = F.size(F.array_distinct(index)) == F.size(index)
    per = F.transform(F.array_distinct(index), lambda c: F.aggregate(F.filter(pairs, lambda p: p["index"] == c), F.lit(0.0), lambda a, p: a + p["value"]))
    return F.when(alone, value).otherwise(per)


class SparseTruncatedSVDModel(Fitted):
    """Its vectors are a table (col, v). Small tables go to every task; large ones are joined to the entries of the rows."""

    axes: DataFrame

    def tables(self):
        return {"axes": self.axes}

    def attach(self, parts, tables):
        self.axes = tables["axes"]

    def _transform(self, df):
        """``svd_features``, an array with one number per component."""
        require(df, [self.col])
        index, value = sparse_entries(df, self.col)
        k = self.n_components
        if self.columns * max(k, 1) > SENT_NUMBERS:
            return self._joined(df, index, value)
        columns, block = collected_basis(self.axes) if k else (np.zeros(0, np.int64), np.zeros((0, 0)))

        @F.pandas_udf("array<double>")
        def score(index: pd.Series, value: pd.Series) -> pd.Series:
            lists = [pa.array(s, pa.list_(t)) for s, t in ((index, pa.int64()), (value, pa.float64()))]
            batch = pa.RecordBatch.from_arrays(lists, names=["index", "value"])
            return pd.Series(list(products(*batch_arrays(batch, columns), block))) if len(index) else pd.Series([], dtype=object)

        return df.withColumn("svd_features", score(index, value))

    def _joined(self, df, index, value):
        spare = "_row"
        while spare in df.columns:
            spare += "_"
        kept = checkpointed(df.withColumn(spare, F.monotonically_increasing_id()))
        entries = kept.select(F.col(spare).alias("row"), F.explode(F.arrays_zip(index.alias("index"), value.alias("value"))).alias("e"))
        met = hot_safe_join(entries.select("row", F.col("e.index").alias("col"), F.col("e.value").alias("x")), self.axes, ["col"])
        sums = met.groupBy("row").agg(F.array(*[F.sum(F.col("x") * F.col("v")[j]) for j in range(self.n_components)]).alias("svd_features"))
        zeros = F.array(*[F.lit(0.0)] * self.n_components)
        out = kept.join(sums.withColumnRenamed("row", spare), spare, "left")
        return out.select(*[F.col(f"`{c}`") for c in df.columns if c != "svd_features"], F.coalesce("svd_features", zeros).alias("svd_features"))


NMF_INITS = ("nndsvd", "nndsvda", "nndsvdar", "random")
SWEEPS = 50


def nonnegative_weights(x: np.ndarray, h: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Rows w >= 0 minimising |x - w h|^2 by coordinate descent, all rows of the block at once."""
    gram, xh = h @ h.T, x @ h.T
    w = np.zeros((len(x), len(h)))
    for _ in range(sweeps):
        before = w.copy()
        for j in range(len(h)):
            if gram[j, j] > 0:
                w[:, j] = np.maximum(0.0, w[:, j] + (xh[:, j] - w @ gram[:, j]) / gram[j, j])
        if np.abs(w - before).max(initial=0.0) <= 1e-9 * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


class NMF(Operator):
    """X ~ W H with non-negative factors, Frobenius loss, by alternating non-negative least squares.

    W is never stored: given H every row solves its own small problem, and a task returns only its share of
    W'X, W'W and |X|^2. So a round is one narrow pass, and nothing has to be checkpointed.
    """

    def __init__(self, cols, n_components=2, init="nndsvd", max_iter=200, tol=1e-4, seed=42):
        super().__init__()
        if init not in NMF_INITS:
            raise ValueError(f"init must be one of {NMF_INITS}")
        self.cols, self.k, self.init, self.max_iter, self.tol, self.seed = names(cols), int(n_components), init, int(max_iter), tol, seed

    def _start(self, rows, m):
        """First H from the leading singular vectors (positive or negative part, whichever is heavier), or random."""
        d = len(self.cols)
        rng = np.random.default_rng(self.seed)
        level = max(float(m.mean.mean()), 1e-12)
        if self.init == "random":
            return np.abs(rng.standard_normal((self.k, d))) * np.sqrt(level / self.k)
        squares, vectors = _eigen(m.raw_cross(), min(self.k, d))

        def halves(batch):
            u = lists_to_matrix(batch.column(0)) @ vectors.T
            return np.concatenate([(np.maximum(u, 0) ** 2).sum(axis=0), (np.minimum(u, 0) ** 2).sum(axis=0)])

        sizes = sum_vectors(rows, halves, 2 * len(vectors))
        h = np.zeros((self.k, d))
        for i, (s, v) in enumerate(zip(np.sqrt(squares), vectors)):
            if i == 0:
                h[0] = np.sqrt(s) * np.abs(v)
                continue
            plus, minus = np.maximum(v, 0), np.maximum(-v, 0)
            up, down = np.sqrt(sizes[i]), np.sqrt(sizes[len(vectors) + i])
            part, other = (plus, up) if np.linalg.norm(plus) * up >= np.linalg.norm(minus) * down else (minus, down)
            size = np.linalg.norm(part)
            if size > 0:
                h[i] = np.sqrt(size * other) * part / size
        if self.init == "nndsvda":
            h[h == 0] = level
        elif self.init == "nndsvdar":
            h[h == 0] = level * rng.random(int((h == 0).sum())) / 100
        h[h.sum(axis=1) == 0] = level
        return h

    def _fit(self, df):
        checked = [F.when(F.col(f"`{c}`") < 0, F.raise_error(F.lit("negative value")).cast("double")).otherwise(F.col(f"`{c}`")).alias(c) for c in self.cols]
        data = as_matrix_columns(df, self.cols).select(*checked)
        rows = data.select(feature_array(data, self.cols).alias("x")).persist()
        try:
            m = moments(data, self.cols)
            if m.n == 0:
                raise ValueError("no rows to fit on")
            h, k, d = self._start(rows, m), self.k, len(self.cols)
            square = float(np.trace(m.raw_cross()))
            last = None
            for round_ in range(1, self.max_iter + 1):
                def part(batch, h=h):
                    x = lists_to_matrix(batch.column(0))
                    w = nonnegative_weights(x, h)
                    return np.concatenate([(w.T @ x).ravel(), (w.T @ w).ravel()])

                sums = sum_vectors(rows, part, k * d + k * k)
                wx, ww = sums[: k * d].reshape(k, d), sums[k * d :].reshape(k, k)
                error = float(np.sqrt(max(0.0, square - 2 * (wx * h).sum() + (ww * (h @ h.T)).sum())))
                if last is not None and last - error <= self.tol * max(last, 1e-300):
                    break
                if round_ == self.max_iter:
                    break
                last = error
                h = self._update(h, wx, ww)
        finally:
            rows.unpersist()
        return NMFModel(cols=self.cols, components=h.tolist(), reconstruction_error=error, n_iter=round_, fitted_samples=m.n)

    @staticmethod
    def _update(h, wx, ww):
        h = h.copy()
        for _ in range(SWEEPS):
            for j in range(len(h)):
                if ww[j, j] > 0:
                    h[j] = np.maximum(0.0, h[j] + (wx[j] - ww[j] @ h) / ww[j, j])
        return h


class NMFModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        h = np.array(self.components)
        k = len(h)

        @F.pandas_udf("array<double>")
        def weights(x):
            return pd.Series(list(nonnegative_weights(np.stack(x.to_numpy()), h))) if len(x) else pd.Series([], dtype=object)

        out = df.withColumn("_w", weights(feature_array(df, self.cols)))
        return out.select("*", *[F.col("_w")[i].alias(f"nmf_component_{i + 1}") for i in range(k)]).drop("_w")

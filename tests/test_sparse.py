"""Wide sparse decomposition and hashed TF-IDF against numpy and plain Python."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from tablelearn.core import load_fitted, save_fitted
from tablelearn.operators import decompose
from tablelearn.operators.decompose import SparseTruncatedSVD
from tablelearn.operators.tfidf import HashedTfidf
from tablelearn.plans import sparse


@pytest.fixture(scope="module")
def wide():
    rng = np.random.default_rng(1)
    x = (rng.random((120, 40)) < 0.15) * rng.random((120, 40)) * np.geomspace(5, 1e-3, 40)
    x[:, 0] += 1.0  # a column that every row has
    x[3] = 0
    return x


@pytest.mark.parametrize("limit", [4_000_000, 10])
def test_sparse_svd_equals_numpy(spark, monkeypatch, tmp_path, wide, limit):
    monkeypatch.setattr(sparse, "SENT_NUMBERS", limit)
    monkeypatch.setattr(decompose, "SENT_NUMBERS", limit)
    monkeypatch.setattr(sparse, "_ENTRIES", 50)
    rows = [(i, {int(j) * 10**8: float(v[j]) for j in np.flatnonzero(v)} if i != 3 else None, f"r{i}") for i, v in enumerate(wide)]
    df = spark.createDataFrame(rows, "id int, m map<long,double>, _row string")
    model = SparseTruncatedSVD("m", 4).fit(df)
    _u, s, vt = np.linalg.svd(wide, full_matrices=False)
    want = wide @ decompose._signed(vt[:4]).T
    assert np.allclose(model.singular_values, s[:4])
    assert np.allclose(model.explained_variance, want.var(axis=0))
    assert np.allclose(model.explained_variance_ratio, want.var(axis=0) / wide.var(axis=0).sum())
    save_fitted(spark, model, str(tmp_path / "svd"))
    out = load_fitted(spark, str(tmp_path / "svd")).transform(df)
    assert out.columns == ["id", "m", "_row", "svd_features"]
    got = {r.id: r.svd_features for r in out.collect()}
    assert np.allclose([got[i] for i in range(len(wide))], want, atol=1e-6)
    unseen = model.transform(spark.createDataFrame([(1, {7: 1.0}, "")], df.schema)).first().svd_features
    assert unseen == [0.0] * 4


def test_sparse_svd_of_vectors_and_low_rank(spark):
    vectors = [(SparseVector(1_000_000, {5: 3.0, 999_999: 4.0}),), (Vectors.dense([0.0] * 10),), (SparseVector(1_000_000, {5: 6.0, 999_999: 8.0}),)]
    model = SparseTruncatedSVD("v", 3).fit(spark.createDataFrame(vectors, ["v"]))
    assert model.n_components == 1 and model.singular_values == pytest.approx([math.sqrt(125)])
    assert {(r["col"], round(r["v"][0], 9)) for r in model.axes.collect()} == {(5, 0.6), (999_999, 0.8)}


def test_sparse_svd_without_rows_or_values(spark):
    none = spark.createDataFrame([], "m map<int,double>")
    assert SparseTruncatedSVD("m", 2).fit(none).singular_values == []
    blank = spark.createDataFrame([({},), (None,)], none.schema)
    model = SparseTruncatedSVD("m", 2).fit(blank)
    assert [r.svd_features for r in model.transform(blank).collect()] == [[], []]
    with pytest.raises(Exception, match="missing value"):
        SparseTruncatedSVD("m", 2).fit(spark.createDataFrame([({1: None},)], none.schema))


def test_tall_qr_equals_one_qr(spark):
    x = np.random.default_rng(3).standard_normal((500, 6))
    block = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "col long, v array<double>").repartition(7)
    r = sparse.tall_qr(block, 6)
    assert np.allclose(r.T @ r, x.T @ x)


def test_hashed_tfidf_equals_plain_counts(spark):
    texts = ["the cat sat on the cat", None, "", "cat and dog", "Dog! dog? DOG."]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    model = HashedTfidf("text", buckets=64).fit(df)
    place = lambda t: int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 64
    bags = [[place(t) for t in (s or "").lower().replace("!", "").replace("?", "").replace(".", "").split()] for s in texts]
    idf = {b: math.log(6 / (1 + sum(b in bag for bag in bags))) + 1 for bag in bags for b in bag}
    got = {r.id: r.tfidf_row for r in model.transform(df).collect()}
    for i, bag in enumerate(bags):
        w = {b: bag.count(b) * idf[b] for b in bag}
        size = math.sqrt(sum(v * v for v in w.values()))
        assert got[i] == pytest.approx({b: v / size for b, v in w.items()})
    unseen = model.transform(spark.createDataFrame([(0, "zebra")], df.schema)).first().tfidf_row
    assert place("zebra") in idf or unseen == {}


def test_what_makes_the_sparse_rows_runs_once(spark):
    """The rows were made anew for every statistic of the fit."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("map<long,double>")
    def row(i):
        made.add(1)
        return {i % 7: 1.0, 50 + i % 3: 2.0}

    SparseTruncatedSVD("m", 2).fit(spark.range(40).select(row("id").alias("m")))
    assert made.value == 40

"""Operators against numpy closed forms, fixtures and properties."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tablelearn.core import Fitted, guarded, load_fitted, save_fitted
from tablelearn.operators.anomaly import IsolationForest
from tablelearn.operators.bayes import GaussianNB
from tablelearn.operators.chain import Chain
from tablelearn.operators.cluster import agglomerative, shift_seeds, spectral
from tablelearn.operators.decompose import NMF, PCA, TruncatedSVD
from tablelearn.operators.encoders import LabelEncoder, OneHotEncoder
from tablelearn.operators.ensemble import CalibratedClassifier, StackingClassifier, VotingClassifier
from tablelearn.operators.imputer import SimpleImputer
from tablelearn.operators.knn import KNNClassifier, KNNRegressor
from tablelearn.operators.linear import ElasticNet, Lasso, LinearRegression, LogisticRegression, Ridge
from tablelearn.operators.metrics import classification_metrics
from tablelearn.operators.mlp import MLPClassifier, MLPRegressor, loss_and_gradient
from tablelearn.operators.scalers import MinMaxScaler, RobustScaler, StandardScaler, normalizer
from tablelearn.operators.select import score_features
from tablelearn.operators.split import train_test_split, with_folds
from tablelearn.operators.svm import SVC, SVR, kernel_features
from tablelearn.operators.tfidf import TfidfVectorizer
from tablelearn.operators.trees import DecisionTreeClassifier, GradientBoostingClassifier, MLModel
from tablelearn.operators.tune import cross_validate, grid_search, leave_one_out
from tablelearn.sources.generate import make_classification, make_regression
from tablelearn.streaming.score import score_stream


@pytest.fixture(scope="module")
def blobs(spark):
    """Two classes of 60 rows and a noisy linear target."""
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(-1, 1, (60, 3)), rng.normal(1, 1, (60, 3))])
    y = x @ [2.0, -1.0, 0.5] + 3 + rng.normal(0, 0.1, 120)
    label = ["no"] * 60 + ["yes"] * 60
    rows = [(i, *map(float, r), float(t), c) for i, (r, t, c) in enumerate(zip(x, y, label))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double, label string").repartition(3).persist()
    return df, x, y, np.array([c == "yes" for c in label])


COLS = ["a", "b", "c"]


def column(out, name):
    return np.array([r[0] for r in out.orderBy("id").select(name).collect()])


def test_collinear_rows_give_the_minimum_norm_line(spark):
    rows = [(1, 2, 5), (2, 3, 8), (3, 4, 11), (4, 5, 14), (5, 6, 17)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rows], "x1 double, x2 double, target double")
    m = LinearRegression("x1, x2", "target").fit(df)
    assert np.allclose([*m.coefficients, m.intercept], [1.5, 1.5, 0.5]) and np.isclose(m.r2_score, 1)
    assert {round(r.prediction, 9) for r in m.transform(df).collect()} == {5, 8, 11, 14, 17}


def test_scaler_fixture_and_constant_column(spark):
    df = spark.createDataFrame([(25, 50000, 1), (35, 75000, 1), (45, 95000, 1), (22, 30000, 1), (28, 40000, 1)], "age int, income int, one int")
    m = StandardScaler("age,income,one").fit(df)
    assert np.allclose(m.mean, [31, 58000, 1]) and np.allclose(m.variance, [67.6, 566e6, 0]) and m.scale[2] == 1.0
    assert MinMaxScaler(["one"]).fit(df).transform(df).first().scaled_one == 0.0
    again = Fitted.from_json(m.to_json())
    assert again.transform(df).collect() == m.transform(df).collect()


def test_inverse_undoes_transform(blobs):
    df, x, _y, _c = blobs
    for op, name in ((MinMaxScaler(COLS, (-2, 3)), "original_a"), (RobustScaler(COLS, quantiles="5-95"), "a_original")):
        out, m = op.fit_transform(df)
        assert np.allclose(column(m.inverse_transform(out), name), x[:, 0])
    out, m = PCA(COLS, 3).fit_transform(df)
    assert np.allclose(column(m.inverse_transform(out), "reconstructed_b"), x[:, 1])


def test_penalised_fits(blobs):
    df, x, y, _c = blobs
    xc, yc, n = x - x.mean(axis=0), y - y.mean(), len(y)
    assert np.allclose(Ridge(COLS, "y", alpha=7.0).fit(df).coefficients, np.linalg.solve(xc.T @ xc + 7 * np.eye(3), xc.T @ yc))
    for op, a, ratio in ((Lasso(COLS, "y", alpha=0.4), 0.4, 1.0), (ElasticNet(COLS, "y", alpha=0.5, l1_ratio=0.3), 0.5, 0.3)):
        w = np.array(op.fit(df).coefficients)
        grad = -xc.T @ (yc - xc @ w) / n + a * (1 - ratio) * w
        assert all(abs(g + a * ratio * np.sign(v)) < 1e-6 if v else abs(g) <= a * ratio + 1e-9 for g, v in zip(grad, w))


def test_logistic_is_stationary(blobs):
    df, x, _y, c = blobs
    m = LogisticRegression(COLS, "label", C=0.5, tol=1e-10, max_iter=500).fit(df)
    w = np.array(m.coefficients[0])
    p = 1 / (1 + np.exp(-(x @ w + m.intercept[0])))
    assert np.abs(x.T @ (p - c) * 0.5 + w).max() < 1e-2 and m.accuracy > 0.8
    assert np.allclose([v[1] for v in column(m.transform(df), "probabilities")], p)


def test_decompositions(blobs):
    df, x, _y, _c = blobs
    m = PCA(COLS, 0).fit(df)
    assert np.allclose(m.explained_variance, np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1])
    assert np.allclose(TruncatedSVD(COLS, 3).fit(df).singular_values, np.linalg.svd(x, compute_uv=False))
    positive = df.select("id", *[F.abs(F.col(c)).alias(c) for c in COLS])
    errors = [NMF(COLS, 2, init, max_iter=k, tol=0).fit(positive).reconstruction_error for init in ("nndsvd", "random") for k in (1, 8)]
    best = np.sqrt((np.linalg.svd(np.abs(x), compute_uv=False)[2:] ** 2).sum())
    assert errors[1] < errors[0] and errors[3] < errors[2] and best <= min(errors) < 1.5 * best
    scores = NMF(COLS, 2, max_iter=5).fit(positive).transform(positive)
    assert scores.where("nmf_component_1 < 0 or nmf_component_2 < 0").count() == 0


def test_encoders_report_unseen_values(spark):
    train, new = spark.createDataFrame([("b",), ("a",)], ["k"]), spark.createDataFrame([("c",)], ["k"])
    with pytest.raises(Exception, match="unseen value"):
        LabelEncoder("k").fit(train).transform(new).collect()
    with pytest.raises(Exception, match="unknown category"):
        OneHotEncoder("k").fit(train).transform(new).collect()
    assert OneHotEncoder("k", handle_unknown="ignore").fit(train).transform(new).select("k_a", "k_b").first() == (0.0, 0.0)
    wide = OneHotEncoder("k", wide=True).fit(train).transform(train)
    assert {tuple(r.k_onehot.toArray()) for r in wide.collect()} == {(1.0, 0.0), (0.0, 1.0)}


def test_bad_input(spark):
    df = spark.createDataFrame([("1", 1.0), ("x", None)], "t string, v double")
    with pytest.raises(ValueError, match="column not found"):
        StandardScaler("nope").fit(df)
    with pytest.raises(Exception, match="missing value"):
        StandardScaler("v").fit(df)
    with pytest.raises(Exception, match="not a number"):
        StandardScaler("t").fit(df)
    assert StandardScaler("v", on_null="drop").fit(df).fitted_samples == 1
    assert "column not found" in guarded(spark, lambda: normalizer(df, "nope"), "row").first().error


def test_imputer_ties_and_empty_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("",), (None,)], "t string")
    out, m = SimpleImputer("t", "most_frequent").fit_transform(df)
    assert sorted(r.t for r in out.collect()) == ["a", "a", "a", "b"] and m.statistics_map() == {"t": "a"}


def test_tfidf_rows_equal_counts_in_small_blocks(spark, monkeypatch):
    from tablelearn.operators import tfidf

    monkeypatch.setattr(tfidf, "DENSE_CELLS", 30)
    rng = np.random.default_rng(14)
    texts = [" ".join(f"word{k}" for k in rng.integers(0, 12, rng.integers(0, 9))) for _ in range(60)] + ["", None, "unseen only"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)
    m = TfidfVectorizer("text", 10, stop_words="none").fit(df)
    got = {r["id"]: r for r in m.transform(df).collect()}
    assert len(got) == len(texts) and m.transform(df.limit(0)).count() == 0
    for i, t in enumerate(texts):
        dense = np.array([(t or "").split().count(name) * w for name, w in zip(m.terms, m.idf)])
        dense = dense / (np.linalg.norm(dense) or 1)
        assert np.allclose(got[i].tfidf_vector, dense)
        assert got[i].tfidf_features == pytest.approx({n: v for n, v in zip(m.terms, dense) if v})


def test_tfidf_row_values(spark):
    df = spark.createDataFrame([(0, "The cat sat on the cat"), (1, "a dog sat"), (2, None)], "id long, text string")
    out, m = TfidfVectorizer("text", ngram=(1, 2), stop_words="english").fit_transform(df)
    assert m.terms == ["cat", "cat sat", "dog", "dog sat", "sat", "sat cat"]
    row = {r.id: r for r in out.collect()}
    assert np.isclose(np.linalg.norm(row[0].tfidf_vector), 1) and row[2].tfidf_features == {} and not any(row[2].tfidf_vector)
    rare, common = np.log(4 / 2) + 1, np.log(4 / 3) + 1
    assert np.isclose(row[0].tfidf_features["cat"] / row[0].tfidf_features["sat"], 2 * rare / common)


@pytest.mark.parametrize("most", [2_000, 8, 3])
def test_bigrams_are_held_to_words_that_can_be_chosen(spark, monkeypatch, most):
    """All bigrams went through the shuffle, though none can occur more often than its words. Ties and too many words included."""
    from tablelearn.operators import tfidf

    monkeypatch.setattr(tfidf, "FREQUENT_WORDS", most)
    rng = np.random.default_rng(15)
    texts = [" ".join(f"w{k}" for k in np.minimum(rng.geometric(0.25, rng.integers(0, 30)), 25)) for _ in range(50)] + ["", None, "once only"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)
    total, docs = {}, {}
    for t in texts:
        words = (t or "").split()
        terms = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        for term in terms:
            total[term] = total.get(term, 0) + 1
        for term in set(terms):
            docs[term] = docs.get(term, 0) + 1
    for features in (2, 7, 30, 5_000):
        op = TfidfVectorizer("text", features, ngram=(1, 2), stop_words="none")
        m = op.fit(df)
        want = sorted(sorted(total, key=lambda t: (-total[t], t))[:features])
        assert m.terms == want and m.counts == [total[t] for t in want]
        assert np.allclose(m.idf, [np.log((1 + len(texts)) / (1 + docs[t])) + 1 for t in want])
        held = op._frequent(df.select("text"), None)
        singles = sorted((n for t, n in total.items() if " " not in t), reverse=True)
        if features == 7 and most == 2_000:
            assert sorted(held) == sorted(t for t, n in total.items() if " " not in t and n >= singles[6])
        if features > most:
            assert held is None
    with pytest.raises(ValueError, match="empty vocabulary"):
        TfidfVectorizer("text", 5, ngram=(1, 2), stop_words="none").fit(df.where("text = ''"))


def test_splits_and_folds_do_not_depend_on_layout(blobs):
    df, *_ = blobs
    train, test = train_test_split(df, "id", 0.25, stratify="label")
    ids = [{r.id for r in part.collect()} for part in (train, test)]
    assert len(ids[1]) == 30 and not ids[0] & ids[1] and len(ids[0] | ids[1]) == 120
    again = train_test_split(df.repartition(7), "id", 0.25, stratify="label")[1]
    assert {r.id for r in again.collect()} == ids[1]
    sizes = {r._fold: r["count"] for r in with_folds(df, "id", 7).groupBy("_fold").count().collect()}
    assert [sizes[f] for f in range(7)] == [18] + [17] * 6


def test_network_gradient():
    rng = np.random.default_rng(0)
    x, y, sizes = rng.normal(size=(5, 3)), rng.normal(size=5), [3, 4, 1]
    flat = rng.normal(size=3 * 4 + 4 + 4 + 1)
    for kind in ("tanh", "logistic", "identity"):
        grad = loss_and_gradient(x, y, flat, sizes, kind, False)[1:]
        for i in range(len(flat)):
            step = np.zeros_like(flat)
            step[i] = 1e-6
            up, down = (loss_and_gradient(x, y, flat + s, sizes, kind, False)[0] for s in (step, -step))
            assert np.isclose(grad[i], (up - down) / 2e-6, rtol=1e-4, atol=1e-6)


def test_kernel_features_reproduce_the_poly_kernel():
    x = np.random.default_rng(0).normal(size=(6, 3))
    z = kernel_features(x, {"kernel": "poly", "gamma": 0.5, "columns": 3})
    assert np.allclose(z @ z.T, (0.5 * x @ x.T) ** 3)


def test_margin_and_network_models_learn(blobs):
    df, *_ = blobs
    assert SVC(COLS, "label", features=60, max_iter=10).fit(df).accuracy > 0.85
    assert SVR(COLS, "y", kernel="linear", max_iter=25).fit(df).r2_score > 0.95
    m = MLPRegressor(COLS, "y", hidden="6", activation="tanh", solver="lbfgs", max_iter=15).fit(df)
    assert m.r2_score > 0.9
    assert np.allclose(column(Fitted.from_json(m.to_json()).transform(df), "prediction"), column(m.transform(df), "prediction"))


def test_trees_save_and_load(spark, blobs, tmp_path):
    df, *_ = blobs
    m = DecisionTreeClassifier(COLS, "label", max_depth=3).fit(df)
    m.save(str(tmp_path / "tree"))
    again = MLModel.load(spark, str(tmp_path / "tree"))
    assert list(column(again.transform(df), "prediction")) == list(column(m.transform(df), "prediction"))
    with pytest.raises(ValueError, match="not supported"):
        from tablelearn.operators.trees import DecisionTreeRegressor
        DecisionTreeRegressor(COLS, "y", criterion="other")
    three = df.withColumn("k", F.when(F.col("a") > 1, "x").when(F.col("b") > 0, "y").otherwise("z"))
    out = GradientBoostingClassifier(COLS, "k", n_estimators=2, max_depth=2).fit(three).transform(three).first()
    assert len(out.probabilities) == 3 and np.isclose(sum(out.probabilities), 1)


def test_ensembles(blobs):
    df, *_ = blobs
    light = {"RandomForestClassifier": {"n_estimators": 4, "max_depth": 3}}
    for op in (
        VotingClassifier(COLS, "label", ["LogisticRegression", "GaussianNB"], "hard"),
        StackingClassifier(COLS, "label", "id", ["RandomForestClassifier", "GaussianNB"], cv=2, params=light),
        CalibratedClassifier(COLS, "label", "id", "GaussianNB", "sigmoid", cv=2),
        CalibratedClassifier(COLS, "label", "id", "SVC", "isotonic", cv=2, params={"kernel": "linear", "max_iter": 5}),
    ):
        model = op.fit(df)
        assert model.accuracy > 0.8
        assert model.transform(df).count() == 120


def test_model_selection(blobs):
    df, x, y, _c = blobs
    rows = cross_validate(df, "id", "LinearRegression", COLS, "y", folds=3)
    slow = cross_validate(df, "id", "LinearRegression", COLS, "y", folds=3, scoring="neg_mean_absolute_error")
    assert all(r["test_score"] > 0.99 for r in rows) and all(r["test_score"] > -0.2 for r in slow)
    loo = column(leave_one_out(df, "id", "LinearRegression", COLS, "y"), "test_score")
    rest = np.arange(120) != 17
    a = np.column_stack([np.ones(119), x[rest]])
    w = np.linalg.lstsq(a, y[rest], rcond=None)[0]
    assert np.isclose(loo[17], -((y[17] - w[0] - x[17] @ w[1:]) ** 2))
    found = grid_search(df, "id", "Ridge", COLS, "y", '{"alpha": [0.01, 1000]}', cv=3)
    assert found.best_params == {"alpha": 0.01} and [r["rank"] for r in found.rows] == [1, 2]
    with pytest.raises(ValueError, match="no closed form"):
        leave_one_out(df, "id", "LogisticRegression", COLS, "label")
    assert cross_validate(df, "id", "LogisticRegression", COLS, "label", "stratified", 2, "roc_auc")[0]["test_score"] > 0.9


def test_isolation_forest_finds_the_far_row(spark, blobs):
    df, *_ = blobs
    far = df.union(spark.createDataFrame([(999, 30.0, 30.0, 30.0, 0.0, "no")], df.schema))
    model = IsolationForest(COLS, "id", n_estimators=30, contamination=0.05).fit(far)
    worst = model.transform(far).orderBy("anomaly_score").first()
    assert worst.id == 999 and worst.is_anomaly and model.n_outliers == 6


def test_chain_composition_and_streaming(spark, blobs, tmp_path):
    df, x, *_ = blobs
    model = Chain(COLS, ["StandardScaler", "PCA", "Normalizer"], "LogisticRegression", "label").fit(df)
    again = Fitted.from_json(model.to_json())
    assert list(column(again.transform(df), "prediction")) == list(column(model.transform(df), "prediction"))
    piped = Pipeline(stages=[StandardScaler(COLS), LinearRegression([f"scaled_{c}" for c in COLS], "y")]).fit(df)
    assert np.corrcoef(column(piped.transform(df), "prediction"), column(df, "y"))[0, 1] > 0.99
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    nb = GaussianNB(COLS, "label").fit(df)
    run = score_stream(nb, stream).select("id", "prediction").writeStream.format("memory").queryName("scored").start()
    run.processAllAvailable()
    run.stop()
    assert {tuple(r) for r in spark.table("scored").collect()} == {tuple(r) for r in nb.transform(df).select("id", "prediction").collect()}
    with pytest.raises(ValueError):
        score_stream(KNNClassifier(COLS, "label", "id").fit(df), stream)


def test_generators(spark):
    one, two = make_regression(spark, 50, 3).orderBy("id").collect(), make_regression(spark, 50, 3).repartition(9).orderBy("id").collect()
    assert one == two and len(one) == 50
    m = LinearRegression("feature_0,feature_1,feature_2", "target").fit(make_regression(spark, 500, 3, weights=[10.0, 20.0, 30.0]))
    assert np.allclose(m.coefficients, [10, 20, 30], atol=2)
    rows = make_classification(spark, 400, 2)
    assert GaussianNB("feature_0,feature_1", "target").fit(rows).accuracy > 0.85
    packed = make_classification(spark, 2500, 2, output="arrays").collect()
    assert sorted(r.n_samples for r in packed) == [500, 1000, 1000]


def test_binary_average_falls_back(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "t string, p string")
    assert classification_metrics(df, "t", "p", "binary").first().average_used == "weighted"


def _groups(rows):
    found = {}
    for r in rows:
        found.setdefault(r["cluster"], set()).add(r["id"])
    return found


def test_spectral_separates_cliques_and_blobs(spark):
    cliques = [(a + base, b + base, 1.0) for base in (0, 100) for a in range(5) for b in range(a)]
    edges = spark.createDataFrame(cliques + [(7, 7, 1.0)], "src long, dst long, weight double")
    nodes = spark.createDataFrame([(i + base,) for base in (0, 100) for i in range(5)] + [(7,), (50,)], "id long")
    got = _groups(spectral(nodes, "id", k=2, affinity="precomputed", edges=edges).collect())
    assert got == {0: set(range(5)), 1: set(range(100, 105)), -1: {7, 50}}
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (30, 2)), rng.normal(50, 1, (30, 2))])
    rows = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    for affinity in ("nearest_neighbors", "rbf"):
        assert _groups(spectral(rows, "id", ["a", "b"], 2, affinity).collect()) == {0: set(range(30)), 1: set(range(30, 60))}
    none = spectral(nodes, "id", k=2, affinity="precomputed", edges=edges.limit(0)).collect()
    assert {r["cluster"] for r in none} == {-1}


def test_ordered_split_keeps_large_ids_apart(spark):
    start = 2**53
    df = spark.range(start, start + 1000)
    for size, want in ((0.251, 251), (0.5, 500), (0.001, 1)):
        _, test = train_test_split(df, "id", size, shuffle=False)
        assert sorted(r["id"] for r in test.collect()) == list(range(start + 1000 - want, start + 1000))
    wide = spark.createDataFrame([(-(2**62),), (0,), (2**62,), (2**62 + 1,)], "id long")
    _, test = train_test_split(wide, "id", 0.25, shuffle=False)
    assert [r["id"] for r in test.collect()] == [2**62 + 1]


def test_mean_shift_drops_seeds_without_rows(spark):
    rows = spark.createDataFrame([(0, [0.0, 0.0]), (1, [0.2, 0.0])], "id long, x array<double>")
    seed, mean, count = shift_seeds(rows, np.array([[9.0, 9.0], [0.0, 0.0]]), 1.0)
    assert seed.tolist() == [1] and count.tolist() == [2] and np.allclose(mean, [[0.1, 0.0]])


def test_scores_with_a_near_unique_target(blobs, spark):
    """The class table may have as many rows as the data; scores equal the closed forms."""
    df, x, _, _ = blobs
    unique = df.withColumn("t", F.when(F.col("id") < 2, F.lit(0)).otherwise(F.col("id")).cast("string"))
    got = score_features(unique, ["a", "b", "c"], "t", "f_classif")
    middle = x.mean(axis=0)
    pair = x[:2].mean(axis=0)
    between = (2 * (pair - middle) ** 2 + ((x[2:] - middle) ** 2).sum(axis=0)) / 118
    assert np.allclose(got, between / ((x[:2] - pair) ** 2).sum(axis=0))
    shifted = unique.select("t", *[(F.col(c) + 10).alias(c) for c in "abc"])
    observed = np.concatenate([(x[:2] + 10).sum(axis=0)[None], x[2:] + 10])
    expected = np.outer(np.array([2] + [1] * 118) / 120, observed.sum(axis=0))
    assert np.allclose(score_features(shifted, ["a", "b", "c"], "t", "chi2"), ((observed - expected) ** 2 / expected).sum(axis=0))


def test_limits_are_errors_not_other_results(spark, blobs):
    with pytest.raises(ValueError):
        DecisionTreeClassifier(["a"], "label", max_depth=31).fit(blobs[0])
    rows = spark.range(300).select("id", F.col("id").cast("double").alias("a"))
    with pytest.raises(ValueError):
        agglomerative(rows, "id", ["a"], 2, "complete")
    assert agglomerative(rows, "id", ["a"], 2, "ward", method="two_stage").count() == 300


@pytest.mark.parametrize("make", [
    lambda: KNNClassifier(["a", "b", "c"], "label", "id", 3), lambda: KNNRegressor(["a", "b", "c"], "y", "id", 3, "distance"),
    lambda: VotingClassifier(["a", "b", "c"], "label", ["LogisticRegression", "RandomForestClassifier"]),
    lambda: StackingClassifier(["a", "b", "c"], "label", "id", ["GaussianNB"], cv=2),
    lambda: CalibratedClassifier(["a", "b", "c"], "label", "id", "GaussianNB", "isotonic", cv=2),
    lambda: DecisionTreeClassifier(["a", "b", "c"], "label", max_depth=3)])
def test_saved_models_predict_the_same(spark, blobs, tmp_path, make):
    df = blobs[0]
    model = make().fit(df)
    save_fitted(spark, model, str(tmp_path))
    again = load_fitted(spark, str(tmp_path))
    want = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert {r["id"]: r["prediction"] for r in again.transform(df).collect()} == want


def test_default_network_learns(blobs):
    df = blobs[0]
    net = MLPClassifier(["a", "b", "c"], "label", hidden="16", max_iter=60, learning_rate=0.01).fit(df)
    assert net.accuracy >= LogisticRegression(["a", "b", "c"], "label").fit(df).accuracy - 0.02

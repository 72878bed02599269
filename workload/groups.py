"""Clustering, outliers, ensembles, model selection and chains."""

from __future__ import annotations

import numpy as np

from tablelearn.operators.anomaly import IsolationForest
from tablelearn.operators.chain import Chain
from tablelearn.operators.cluster import KMeans, KMeansModel, MeanShift, agglomerative, dbscan, dbscan_summary, shift_seeds, spectral
from tablelearn.operators.ensemble import CalibratedClassifier, StackingClassifier, VotingClassifier, VotingModel
from tablelearn.operators.linear import LinearRegression, LogisticModel
from tablelearn.operators.tune import cross_validate, cv_summary, fold_table, grid_search, leave_one_out
from tablelearn.plans.neighbors import points

from .base import F, query, r, table
from .models import SMALL, _binary_orders, _customers, _one, _orders, _small


def _parts(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (F.col("p_size") / 10).alias("a"), ((F.col("p_retailprice") - 900) / 20).alias("b"))


PART_X = "x AS (SELECT p_partkey AS id, p_size / 10 AS a, (p_retailprice - 900) / 20 AS b FROM part)"


def _lloyd_sql(k, rounds):
    steps = [f"WITH {PART_X}", f"""c0 AS (SELECT (row_number() OVER (ORDER BY md5(id || '-42')) - 1)::INT AS c, a, b FROM x
        QUALIFY row_number() OVER (ORDER BY md5(id || '-42')) <= {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (SELECT x.id, x.a, x.b, c, (x.a - c{i}.a) ** 2 + (x.b - c{i}.b) ** 2 AS g FROM x, c{i}
            QUALIFY row_number() OVER (PARTITION BY x.id ORDER BY (x.a - c{i}.a) ** 2 + (x.b - c{i}.b) ** 2, c) = 1)""")
        steps.append(f"c{i + 1} AS (SELECT c, avg(a) AS a, avg(b) AS b FROM d{i} GROUP BY c)")
    return ", ".join(steps)


def _kmeans(spark, sf):
    return KMeans(["a", "b"], 3, "random", max_iter=3, n_init=1, tol=0.0, id_col="id").fit(_parts(spark, sf))


@query("kmeans_fit", _lloyd_sql(3, 3) + """
SELECT c AS cluster, round(a, 6) AS a, round(b, 6) AS b, (SELECT round(sum(g), 4) FROM d3) AS inertia FROM c3""")
def _(spark, sf):
    m = _kmeans(spark, sf)
    out = spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(m.centers)], "cluster int, a double, b double")
    return out.select("cluster", r("a").alias("a"), r("b").alias("b"), r(F.lit(m.inertia), 4).alias("inertia"))


@query("kmeans_fit_predict", _lloyd_sql(3, 3) + " SELECT id, c AS cluster FROM d3")
def _(spark, sf):
    return _kmeans(spark, sf).transform(_parts(spark, sf)).select("id", "cluster")


CENTERS = [[1.0, 1.0], [2.5, 2.5], [4.0, 4.0]]


@query("kmeans_predict", f"WITH {PART_X}, d AS (SELECT id, " + ", ".join(
    f"sqrt((a - {c[0]}) ** 2 + (b - {c[1]}) ** 2) AS d{i}" for i, c in enumerate(CENTERS)) + """ FROM x)
SELECT id, round(d0, 6) AS d0, round(d1, 6) AS d1, round(d2, 6) AS d2, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster FROM d""")
def _(spark, sf):
    out = KMeansModel(cols=["a", "b"], centers=CENTERS).transform(_parts(spark, sf))
    return out.select("id", *[r(F.col("distances_to_centers")[i]).alias(f"d{i}") for i in range(3)], "cluster")


@query("kmeans_parallel_seeding")
def _(spark, sf):
    model = KMeans(["embedding"], 10, n_init=2, max_iter=20).fit(table(spark, sf, "embeddings"))
    return model.transform(table(spark, sf, "embeddings")).select("vec_id", "cluster")


def _eps_sql(eps, min_samples, x, dist="(p.a - q.a) ** 2 + (p.b - q.b) ** 2", limit=None):
    return f"""
WITH RECURSIVE x AS ({x}),
     near AS (SELECT p.id, q.id AS other FROM x p JOIN x q ON {dist} <= {limit or eps * eps}),
     core AS (SELECT id FROM near GROUP BY id HAVING count(*) >= {min_samples}),
     e AS (SELECT near.id, other FROM near JOIN core a ON a.id = near.id JOIN core b ON b.id = other),
     reach(id, root) AS (SELECT id, id FROM core UNION SELECT e.other, reach.root FROM reach JOIN e ON e.id = reach.id),
     comp AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
     number AS (SELECT root, (row_number() OVER (ORDER BY root) - 1)::INT AS cluster FROM (SELECT DISTINCT root FROM comp)),
     label AS (SELECT id, root, true AS is_core FROM comp UNION ALL
               SELECT near.id, min(root), false FROM near JOIN comp ON comp.id = other WHERE near.id NOT IN (SELECT id FROM core) GROUP BY near.id)"""


CUST_X = "SELECT c_custkey AS id, c_acctbal / 100 AS a, c_nationkey::DOUBLE AS b FROM customer"


def _cust(spark, sf):
    return _customers(spark, sf).select("id", (F.col("y") / 100).alias("a"), "b")


@query("dbscan", _eps_sql(1.5, 5, CUST_X) + """
SELECT x.id, coalesce(cluster, -1)::INT AS cluster, coalesce(is_core, false) AS is_core_sample, cluster IS NULL AS is_noise
FROM x LEFT JOIN label USING (id) LEFT JOIN number USING (root)""")
def _(spark, sf):
    return dbscan(_cust(spark, sf), "id", ["a", "b"], 1.5, 5).select("id", "cluster", "is_core_sample", "is_noise")


@query("dbscan_manhattan", _eps_sql(2.0, 6, CUST_X, "abs(p.a - q.a) + abs(p.b - q.b)", 2.0) + """
SELECT count(DISTINCT cluster) AS n_clusters, sum((cluster IS NULL)::INT)::BIGINT AS n_noise, sum(coalesce(is_core, false)::INT)::BIGINT AS n_core
FROM x LEFT JOIN label USING (id) LEFT JOIN number USING (root)""")
def _(spark, sf):
    return dbscan_summary(dbscan(_cust(spark, sf), "id", ["a", "b"], 2.0, 6, "manhattan"))


@query("dbscan_vectors", _eps_sql(0.6, 4, "SELECT vec_id AS id, embedding::DOUBLE[] AS a FROM embeddings", "1 - list_cosine_similarity(p.a, q.a)", 0.6) + """
SELECT x.id AS vec_id, coalesce(cluster, -1)::INT AS cluster, coalesce(is_core, false) AS is_core_sample
FROM x LEFT JOIN label USING (id) LEFT JOIN number USING (root)""")
def _(spark, sf):
    out = dbscan(table(spark, sf, "embeddings"), "vec_id", ["embedding"], 0.6, 4, "cosine")
    return out.select("vec_id", "cluster", "is_core_sample")


@query("agglomerative_single", _eps_sql(1.2, 1, CUST_X) + " SELECT id, cluster FROM label JOIN number USING (root)")
def _(spark, sf):
    return agglomerative(_cust(spark, sf), "id", ["a", "b"], linkage="single", distance_threshold=1.2).select("id", "cluster")


@query("agglomerative")
def _(spark, sf):
    return agglomerative(_cust(spark, sf), "id", ["a", "b"], 4, "ward", method="two_stage").select("id", "cluster")


@query("spectral")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return spectral(vectors, "vec_id", ["embedding"], 3, "nearest_neighbors", 10).select("vec_id", "cluster")


@query("spectral_regions", """
WITH nodes AS (SELECT c_custkey AS id, n_regionkey AS g FROM customer JOIN nation ON c_nationkey = n_nationkey
               UNION ALL SELECT 1000000000 + n_nationkey, n_regionkey FROM nation UNION ALL SELECT 2000000000 + r_regionkey, r_regionkey FROM region),
     least AS (SELECT g, min(id) AS m FROM nodes GROUP BY g)
SELECT id, (dense_rank() OVER (ORDER BY m) - 1)::INT AS cluster FROM nodes JOIN least USING (g)""")
def _(spark, sf):
    """Customers hang on their nations, nations on their regions: as many separate parts as there are regions."""
    nation, region = F.col("n_nationkey") + 1_000_000_000, F.col("n_regionkey") + 2_000_000_000
    nations = table(spark, sf, "nation")
    edges = table(spark, sf, "customer").select(F.col("c_custkey").alias("src"), (F.col("c_nationkey") + 1_000_000_000).alias("dst"), F.lit(1.0).alias("weight"))
    edges = edges.unionByName(nations.select(nation.cast("long").alias("src"), region.cast("long").alias("dst"), F.lit(100.0).alias("weight")))
    nodes = edges.select(F.col("src").alias("id")).union(edges.select("dst")).distinct()
    return spectral(nodes, "id", k=table(spark, sf, "region").count(), affinity="precomputed", edges=edges).select("id", "cluster")


@query("mean_shift")
def _(spark, sf):
    rows = _parts(spark, sf)
    return MeanShift(["a", "b"], "id", bandwidth=1.5, bin_seeding=True).fit(rows).transform(rows).select("id", "cluster", "n_clusters")


SEEDS = [[1.0, 1.0], [4.0, 4.0], [2.0, 3.0]]


@query("mean_shift_step", f"WITH {PART_X}, s AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(SEEDS)) + """) t(seed, sa, sb))
SELECT seed, count(*) AS n, round(avg(a), 6) AS a, round(avg(b), 6) AS b FROM x JOIN s ON (a - sa) ** 2 + (b - sb) ** 2 <= 1.0 GROUP BY seed""")
def _(spark, sf):
    seed, mean, count = shift_seeds(points(_parts(spark, sf), "id", ["a", "b"], "euclidean"), np.array(SEEDS), 1.0)
    rows = [(i, int(n), *map(float, m)) for i, m, n in zip(seed.tolist(), mean, count)]
    out = spark.createDataFrame(rows, "seed int, n long, a double, b double")
    return out.select("seed", "n", r("a").alias("a"), r("b").alias("b"))


@query("isolation_forest_train", "SELECT count(*) AS training_samples, ceil(0.1 * (count(*) - 1))::BIGINT AS n_outliers FROM orders")
def _(spark, sf):
    m = IsolationForest(["p", "c"], "o_orderkey", n_estimators=50).fit(_orders(spark, sf))
    return _one(spark, dict(training_samples=m.training_samples, n_outliers=m.n_outliers))


@query("isolation_forest_predict")
def _(spark, sf):
    orders = _orders(spark, sf)
    out = IsolationForest(["p", "c"], "o_orderkey", n_estimators=20, contamination=0.05).fit(orders).transform(orders)
    return out.select("o_orderkey", "is_anomaly", r("anomaly_score").alias("anomaly_score"))


MEMBER_SQL = """
WITH x AS (SELECT c_custkey AS id, c_acctbal / 1000 AS a, c_nationkey::DOUBLE AS b FROM customer),
     m AS (SELECT id, 1 / (1 + exp(-(0.5 * a - 0.1 * b - 1))) AS p0, 1 / (1 + exp(-(-0.2 * a + 0.3 * b - 2))) AS p1, 1 / (1 + exp(-(0.1 * a + 0.1 * b - 2))) AS p2 FROM x)"""


def _fixed_votes(voting):
    model = VotingModel(cols=["a", "b"], target="s", estimators=[], voting=voting, classes=["no", "yes"])
    fixed = ([0.5, -0.1], -1.0), ([-0.2, 0.3], -2.0), ([0.1, 0.1], -2.0)
    model.members = [LogisticModel(cols=["a", "b"], classes=["no", "yes"], coefficients=[w], intercept=[b]) for w, b in fixed]
    return model


@query("voting_predict", MEMBER_SQL + """
SELECT id, CASE WHEN (p0 + p1 + p2) / 3 > 0.5 THEN 'yes' ELSE 'no' END AS prediction, round((p0 + p1 + p2) / 3, 6) AS probability FROM m""")
def _(spark, sf):
    out = _fixed_votes("soft").transform(_customers(spark, sf))
    return out.select("id", "prediction", r(F.col("probabilities")[1]).alias("probability"))


@query("voting_predict_hard", MEMBER_SQL + """
SELECT id, CASE WHEN (p0 > 0.5)::INT + (p1 > 0.5)::INT + (p2 > 0.5)::INT >= 2 THEN 'yes' ELSE 'no' END AS prediction FROM m""")
def _(spark, sf):
    return _fixed_votes("hard").transform(_customers(spark, sf)).select("id", "prediction")


LIGHT = {"RandomForestClassifier": {"n_estimators": 5, "max_depth": 4}, "GradientBoostingClassifier": {"n_estimators": 3, "max_depth": 2}}


@query("voting_train")
def _(spark, sf):
    return VotingClassifier(["a", *SMALL], "rich", params=LIGHT).fit(_small(spark, sf)).summary(spark)


# Two members fitted on all orders, a normal and a multinomial one; the mean of their probabilities decides.
@query("voting_bayes", """
WITH x AS (SELECT o_orderkey, o_orderstatus AS c, o_totalprice / 100000 AS p, o_custkey / 1000 AS k FROM orders),
g AS (SELECT c, count(*) AS n, avg(p) AS mp, avg(k) AS mk, var_pop(p) AS vp, var_pop(k) AS vk, ln((sum(p) + 1) / (sum(p) + sum(k) + 2)) AS wp,
             ln((sum(k) + 1) / (sum(p) + sum(k) + 2)) AS wk FROM x GROUP BY c),
e AS (SELECT 1e-9 * greatest(var_pop(p), var_pop(k)) AS e, count(*) AS nn FROM x),
j AS (SELECT o_orderkey, g.c, ln(n / nn) - 0.5 * ln(vp + e) - (p - mp) ** 2 / (2 * (vp + e)) - 0.5 * ln(vk + e) - (k - mk) ** 2 / (2 * (vk + e)) AS s0,
             ln(n / nn) + p * wp + k * wk AS s1 FROM x, g, e),
m AS (SELECT o_orderkey, c, exp(s0 - max(s0) OVER w) AS e0, exp(s1 - max(s1) OVER w) AS e1 FROM j WINDOW w AS (PARTITION BY o_orderkey)),
q AS (SELECT o_orderkey, c, (e0 / sum(e0) OVER w + e1 / sum(e1) OVER w) / 2 AS p FROM m WINDOW w AS (PARTITION BY o_orderkey))
SELECT o_orderkey, arg_max(c, p) AS prediction, round(max(p), 6) AS probability FROM q GROUP BY o_orderkey""")
def _(spark, sf):
    rows = _orders(spark, sf)
    out = VotingClassifier(["p", "c"], "o_orderstatus", ["GaussianNB", "MultinomialNB"]).fit(rows).transform(rows)
    return out.select("o_orderkey", "prediction", r(F.array_max("probabilities")).alias("probability"))


@query("stacking_train")
def _(spark, sf):
    op = StackingClassifier([*SMALL, "a"], "rich", "id", ("RandomForestClassifier", "GaussianNB"), cv=3, params=LIGHT)
    return op.fit(_small(spark, sf)).summary(spark)


@query("stacking_predict")
def _(spark, sf):
    rows = _small(spark, sf)
    model = StackingClassifier([*SMALL, "a"], "rich", "id", ("LogisticRegression", "GaussianNB"), cv=3).fit(rows)
    return model.transform(rows).select("id", "prediction", r(F.col("probabilities")[1], 4).alias("probability"))


@query("calibrated_train")
def _(spark, sf):
    return CalibratedClassifier([*SMALL, "a"], "rich", "id", base="GaussianNB", cv=3).fit(_small(spark, sf)).summary(spark)


@query("calibrated_predict")
def _(spark, sf):
    rows = _small(spark, sf)
    model = CalibratedClassifier([*SMALL, "a"], "rich", "id", base="LogisticRegression", method="isotonic", cv=3).fit(rows)
    return model.transform(rows).select("id", "prediction", r(F.col("calibrated_probabilities")[1], 4).alias("probability"))


FOLD_LINE = """
WITH x AS (SELECT o_totalprice AS y, o_custkey AS x, ntile(5) OVER (ORDER BY md5(o_orderkey || '-42')) - 1 AS f FROM orders),
     k AS (SELECT unnest(range(5)) AS fold),
     w AS (SELECT fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x, k WHERE f <> fold GROUP BY fold)"""


@query("cv_kfold", FOLD_LINE + """
SELECT fold::INT AS fold, round(1 - avg(CASE WHEN f = fold THEN (y - a - b * x) ** 2 END) / var_pop(CASE WHEN f = fold THEN y END), 8) + 0.0 AS test_score,
       round(1 - avg(CASE WHEN f <> fold THEN (y - a - b * x) ** 2 END) / var_pop(CASE WHEN f <> fold THEN y END), 8) + 0.0 AS train_score
FROM x, w GROUP BY fold""")
def _(spark, sf):
    rows = cross_validate(table(spark, sf, "orders"), "o_orderkey", "LinearRegression", "o_custkey", "o_totalprice")
    return fold_table(spark, rows).select("fold", r("test_score", 8).alias("test_score"), r("train_score", 8).alias("train_score"))


@query("cv_stratified", """
WITH x AS (SELECT o_orderkey, o_orderstatus AS c, o_totalprice / 100000 AS p, ntile(4) OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || '-42')) - 1 AS f FROM orders),
     k AS (SELECT unnest(range(4)) AS fold),
     g AS (SELECT fold, c, count(*) AS n, avg(p) AS m, var_pop(p) AS v FROM x, k WHERE f <> fold GROUP BY ALL),
     e AS (SELECT fold, 1e-9 * var_pop(p) AS e, count(*) AS nn FROM x, k WHERE f <> fold GROUP BY fold),
     s AS (SELECT fold, f, o_orderkey, x.c AS truth, arg_max(g.c, ln(n / nn) - 0.5 * ln(2 * pi() * (v + e)) - (p - m) ** 2 / (2 * (v + e))) AS z
           FROM x JOIN g ON true JOIN e USING (fold) GROUP BY fold, f, o_orderkey, x.c)
SELECT fold::INT AS fold, round(avg(CASE WHEN f = fold THEN (truth = z)::INT END), 6) AS test_score,
       round(avg(CASE WHEN f <> fold THEN (truth = z)::INT END), 6) AS train_score FROM s GROUP BY fold""")
def _(spark, sf):
    rows = cross_validate(_orders(spark, sf), "o_orderkey", "GaussianNB", "p", "o_orderstatus", "stratified", 4)
    return fold_table(spark, rows).select("fold", r("test_score").alias("test_score"), r("train_score").alias("train_score"))


@query("cv_shuffle", """
WITH x AS (SELECT o_totalprice AS y, o_custkey AS x, k.fold, row_number() OVER (PARTITION BY k.fold ORDER BY md5(o_orderkey || '-42-' || k.fold))
                  <= (SELECT ceil(0.2 * count(*)) FROM orders) AS test FROM orders, (SELECT unnest(range(3)) AS fold) k),
     w AS (SELECT fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM x WHERE NOT test GROUP BY fold)
SELECT fold::INT AS fold, round(1 - avg((y - a - b * x) ** 2) / var_pop(y), 8) + 0.0 AS test_score FROM x JOIN w USING (fold) WHERE test GROUP BY fold""")
def _(spark, sf):
    rows = cross_validate(table(spark, sf, "orders"), "o_orderkey", "LinearRegression", "o_custkey", "o_totalprice", "shuffle", 3)
    return fold_table(spark, rows).select("fold", r("test_score", 8).alias("test_score"))


@query("cv_loo", """
WITH s AS (SELECT count(*) AS n, avg(c_nationkey) AS m, var_pop(c_nationkey) * count(*) AS v, regr_slope(c_acctbal, c_nationkey) AS b,
                  regr_intercept(c_acctbal, c_nationkey) AS a FROM customer)
SELECT c_custkey AS id, round(-1 * ((c_acctbal - a - b * c_nationkey) / (1 - 1 / n - (c_nationkey - m) ** 2 / v)) ** 2, 1) + 0.0 AS test_score FROM customer, s""")
def _(spark, sf):
    out = leave_one_out(table(spark, sf, "customer"), "c_custkey", "LinearRegression", "c_nationkey", "c_acctbal")
    return out.select("id", r("test_score", 1).alias("test_score"))


@query("cv_loo_knn", """
WITH t AS (SELECT c_custkey AS id, c_acctbal / 1000 AS a, c_nationkey::DOUBLE AS b, c_mktsegment AS s FROM customer),
     d AS (SELECT q.id AS query, t.id AS neighbor, t.s, (q.a - t.a) ** 2 + (q.b - t.b) ** 2 AS d FROM t q JOIN t ON q.id <> t.id),
     n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY query ORDER BY d, neighbor) <= 3),
     v AS (SELECT query, s, count(*) AS votes FROM n GROUP BY ALL),
     p AS (SELECT query, s FROM v QUALIFY row_number() OVER (PARTITION BY query ORDER BY votes DESC, s) = 1)
SELECT query AS id, (p.s = t.s)::INT::DOUBLE AS test_score FROM p JOIN t ON t.id = query""")
def _(spark, sf):
    return leave_one_out(_customers(spark, sf), "id", "KNeighborsClassifier", ["a", "b"], "s", params={"k": 3})


@query("cv_loo_ridge", """
WITH s AS (SELECT count(*) AS n, avg(c_nationkey) AS m, avg(c_acctbal) AS my, var_pop(c_nationkey) * count(*) + 500 AS v,
                  covar_pop(c_acctbal, c_nationkey) * count(*) AS u FROM customer)
SELECT c_custkey AS id, round(-1 * abs(c_acctbal - my - u / v * (c_nationkey - m)) / (1 - 1 / n - (c_nationkey - m) ** 2 / v), 4) + 0.0 AS test_score FROM customer, s""")
def _(spark, sf):
    out = leave_one_out(table(spark, sf, "customer"), "c_custkey", "Ridge", "c_nationkey", "c_acctbal", "neg_mean_absolute_error", {"alpha": 500.0})
    return out.select("id", r("test_score", 4).alias("test_score"))


def _loo_sql(p, k, stats, score):
    """Sums of each class less the row itself, joined to every row; the likeliest class."""
    return f"""
WITH x AS (SELECT o_orderkey AS id, o_orderstatus AS c, {p} AS p, {k} AS k FROM orders),
g AS (SELECT c, count(*) AS n, sum(p) AS p1, sum(k) AS k1, sum(p * p) AS p2, sum(k * k) AS k2 FROM x GROUP BY c),
a AS (SELECT sum(n) - 1 AS nn, sum(p1) AS p1, sum(k1) AS k1, sum(p2) AS p2, sum(k2) AS k2 FROM g),
o AS (SELECT id, x.c AS truth, g.c, x.p, x.k, (x.c = g.c)::INT AS own, nn, a.p1 - x.p AS tp1, a.p2 - x.p * x.p AS tp2, a.k1 - x.k AS tk1, a.k2 - x.k * x.k AS tk2,
             g.n - own AS n, g.p1 - own * x.p AS p1, g.k1 - own * x.k AS k1, g.p2 - own * x.p * x.p AS p2, g.k2 - own * x.k * x.k AS k2 FROM x, g, a),
m AS (SELECT *, {stats} FROM o WHERE n > 0)
SELECT id, (arg_max(c, ln(n / nn) + {score}) = any_value(truth))::INT::DOUBLE AS test_score FROM m GROUP BY id"""


def _normal(v):
    return f"- 0.5 * ln(2 * pi() * (v{v} + e)) - ({v} - {v}1 / n) ** 2 / (2 * (v{v} + e))"


LOO_BAYES = {
    "gaussian_nb": ("GaussianNB", _orders, _loo_sql(
        "o_totalprice / 100000", "o_custkey / 1000",
        "p2 / n - (p1 / n) ** 2 AS vp, k2 / n - (k1 / n) ** 2 AS vk, 1e-9 * greatest(tp2 / nn - (tp1 / nn) ** 2, tk2 / nn - (tk1 / nn) ** 2) AS e",
        f"0 {_normal('p')} {_normal('k')}")),
    "multinomial_nb": ("MultinomialNB", _orders, _loo_sql(
        "o_totalprice / 100000", "o_custkey / 1000", "p1 + k1 + 2 AS pk", "p * ln((p1 + 1) / pk) + k * ln((k1 + 1) / pk)")),
    "bernoulli_nb": ("BernoulliNB", _binary_orders, _loo_sql(
        "(o_totalprice > 250000)::INT", "(o_custkey > 700)::INT", "(p1 + 1) / (n + 2) AS qp, (k1 + 1) / (n + 2) AS qk",
        "ln(CASE p WHEN 1 THEN qp ELSE 1 - qp END) + ln(CASE k WHEN 1 THEN qk ELSE 1 - qk END)")),
}
for _name, (_model, _rows, _sql) in LOO_BAYES.items():
    @query(f"cv_loo_{_name}", _sql)
    def _(spark, sf, model=_model, rows=_rows):
        return leave_one_out(rows(spark, sf), "o_orderkey", model, ["p", "c"], "o_orderstatus")


@query("cv_classifier")
def _(spark, sf):
    rows = cross_validate(_small(spark, sf), "id", "DecisionTreeClassifier", ["a", *SMALL], "rich", "stratified", 3, "f1_weighted", params={"max_depth": 2})
    return _one(spark, cv_summary(rows))


ALPHAS = [10.0, 100000.0, 10000000.0]


@query("grid_search", f"""
WITH x AS (SELECT o_totalprice AS y, o_custkey AS x, ntile(5) OVER (ORDER BY md5(o_orderkey || '-42')) - 1 AS f FROM orders),
     k AS (SELECT unnest(range(5)) AS fold), a AS (SELECT unnest({ALPHAS}) AS alpha),
     s AS (SELECT fold, count(*) AS n, covar_pop(x, y) AS c, var_pop(x) AS v, avg(x) AS mx, avg(y) AS my FROM x, k WHERE f <> fold GROUP BY fold),
     w AS (SELECT fold, alpha, c * n / (v * n + alpha) AS b, my - c * n / (v * n + alpha) * mx AS a FROM s, a),
     t AS (SELECT alpha, fold, avg((y - a - b * x) ** 2) AS e FROM x JOIN w ON f = fold GROUP BY ALL),
     m AS (SELECT alpha, -avg(e) AS mean_test, stddev_pop(e) AS std_test FROM t GROUP BY alpha)
SELECT alpha, round(mean_test, 0) + 0.0 AS mean_test_score, round(std_test, 0) AS std_test_score, rank() OVER (ORDER BY mean_test DESC)::INT AS rank_test_score FROM m""")
def _(spark, sf):
    found = grid_search(table(spark, sf, "orders"), "o_orderkey", "Ridge", "o_custkey", "o_totalprice", {"alpha": ALPHAS}, scoring="neg_mean_squared_error")
    out = found.table(spark)
    return out.select(F.get_json_object("params", "$.alpha").cast("double").alias("alpha"), r("mean_test_score", 0).alias("mean_test_score"),
                      r("std_test_score", 0).alias("std_test_score"), "rank_test_score")


@query("grid_search_knn", """
WITH t AS (SELECT c_custkey AS id, c_acctbal / 1000 AS a, c_nationkey::DOUBLE AS b, c_mktsegment AS s,
                  ntile(2) OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '-42')) - 1 AS f FROM customer),
n AS (SELECT fold, q.id, q.f, q.s AS truth, t.s, row_number() OVER (PARTITION BY fold, q.id ORDER BY (q.a - t.a) ** 2 + (q.b - t.b) ** 2, t.id) AS place
      FROM (SELECT unnest(range(2)) AS fold) k JOIN t ON t.f <> fold JOIN t q ON true QUALIFY place <= 7),
v AS (SELECT fold, k, id, f, truth, s, count(*) AS votes FROM n, (SELECT unnest([3, 7]) AS k) WHERE place <= k GROUP BY ALL),
p AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY fold, k, id ORDER BY votes DESC, s) = 1),
z AS (SELECT k, fold, avg((truth = s)::INT) FILTER (f = fold) AS test, avg((truth = s)::INT) FILTER (f <> fold) AS train FROM p GROUP BY k, fold),
m AS (SELECT k, avg(test) AS test, stddev_pop(test) AS std, avg(train) AS train FROM z GROUP BY k)
SELECT '{"n_neighbors": ' || k || '}' AS params, round(test, 6) AS mean_test_score, round(std, 6) AS std_test_score, round(train, 6) AS mean_train_score,
       rank() OVER (ORDER BY test DESC)::INT AS rank_test_score FROM m""")
def _(spark, sf):
    found = grid_search(_customers(spark, sf), "id", "KNeighborsClassifier", ["a", "b"], "s", '{"n_neighbors": [3, 7]}', cv=2, return_model=False)
    return found.table(spark).select("params", *[r(c).alias(c) for c in ("mean_test_score", "std_test_score", "mean_train_score")], "rank_test_score")


CHAIN_SQL = """
WITH s AS (SELECT avg(o_custkey) AS m, stddev_pop(o_custkey) AS d, min((o_custkey)) AS lo, max(o_custkey) AS hi FROM orders)"""


@query("chain_train", """
SELECT 'StandardScaler,MinMaxScaler,LinearRegression' AS steps, round(regr_r2(o_totalprice, o_custkey), 9) + 0.0 AS score FROM orders""")
def _(spark, sf):
    m = Chain("o_custkey", ["StandardScaler", "MinMaxScaler"], "LinearRegression", "o_totalprice").fit(table(spark, sf, "orders"))
    return _one(spark, dict(steps=",".join(m.steps), score=m.score), dict(score=9))


@query("chain_predict", """
WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders)
SELECT o_orderkey, round(a + b * o_custkey, 4) AS prediction FROM orders, f""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    out = Chain("o_custkey", ["StandardScaler", "RobustScaler"], "LinearRegression", "o_totalprice").fit(orders).transform(orders)
    return out.select("o_orderkey", r("prediction", 4).alias("prediction"))


@query("chain_scaled_predict", """
WITH s AS (SELECT avg(o_custkey) AS m, stddev_pop(o_custkey) AS d, min(o_custkey) AS lo, max(o_custkey) AS hi FROM orders),
     z AS (SELECT o_orderkey, o_totalprice AS y, (o_custkey - m) / d AS z, ((o_custkey - lo) / (hi - lo)) ** 2 AS q FROM orders, s),
     f AS (SELECT regr_slope(y, q) AS b, regr_intercept(y, q) AS a FROM z)
SELECT o_orderkey, round(a + b * q, 3) AS prediction FROM z, f""")
def _(spark, sf):
    """A square is not undone by an affine step before it, so the prediction depends on the scaler."""
    orders = table(spark, sf, "orders")
    model = Chain("o_custkey", ["StandardScaler", "MinMaxScaler", "PolynomialFeatures"]).fit(orders)
    squared = model.transform(orders).withColumn("q", F.col("transformed_3"))
    out = LinearRegression("q", "o_totalprice").fit(squared).transform(squared)
    return out.select("o_orderkey", r("prediction", 3).alias("prediction"))


@query("chain_transform", CHAIN_SQL + """, z AS (SELECT o_orderkey, (o_custkey - lo) / (hi - lo) AS z FROM orders, s)
SELECT o_orderkey, 1.0::DOUBLE AS transformed_1, round(z, 6) AS transformed_2, round(z * z, 6) AS transformed_3 FROM z""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    out = Chain("o_custkey", ["StandardScaler", "MinMaxScaler", "PolynomialFeatures"]).fit(orders).transform(orders)
    return out.select("o_orderkey", *[r(f"transformed_{i}").alias(f"transformed_{i}") for i in (1, 2, 3)])

"""Regression and classification."""

from __future__ import annotations

from tablelearn.operators.bayes import BernoulliNB, GaussianNB, MultinomialNB
from tablelearn.operators.knn import KNNClassifier, KNNRegressor
from tablelearn.operators.linear import ElasticNet, Lasso, LinearModel, LinearRegression, LogisticModel, LogisticRegression, Ridge
from tablelearn.operators.metrics import regression_metrics
from tablelearn.operators.mlp import MLPClassifier, MLPRegressor
from tablelearn.operators.scalers import StandardScaler
from tablelearn.operators.svm import SVC, SVR
from tablelearn.operators.trees import (
    DecisionTreeClassifier, DecisionTreeRegressor, GradientBoostingClassifier, GradientBoostingRegressor,
    RandomForestClassifier, RandomForestRegressor,
)

from .base import F, query, r, spread, table


def _lines(spark, sf, heavy=False):
    lines = table(spark, sf, "lineitem")
    return (spread(lines) if heavy else lines).select(
        F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_tax").alias("t"), F.col("l_linenumber").alias("ln"),
        F.col("l_extendedprice").alias("y"), F.col("l_returnflag").alias("f"))


def _orders(spark, sf):
    return spread(table(spark, sf, "orders")).select("o_orderkey", "o_orderstatus", (F.col("o_totalprice") / 100000).alias("p"), (F.col("o_custkey") / 1000).alias("c"))


def _one(spark, values: dict, digits: dict | None = None):
    rows = spark.createDataFrame([tuple(values.values())], list(values))
    numeric = {n for n, t in rows.dtypes if t == "double"}
    return rows.select(*[r(c, (digits or {}).get(c, 6)).alias(c) if c in numeric else F.col(c) for c in rows.columns])


def flagship(spark, sf):
    """Scale a column, fit a line on it, predict every row and evaluate the fit."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    scaled, _scaler = StandardScaler("o_custkey").fit_transform(orders)
    model = LinearRegression("scaled_o_custkey", "o_totalprice").fit(scaled)
    m = regression_metrics(model.transform(scaled), "o_totalprice", "prediction")
    return m.select(r("rmse", 4).alias("rmse"), r("mae", 4).alias("mae"), r("r2", 9).alias("r2"), "support").withColumn(
        "slope", r(F.lit(model.coefficients[0]), 4)).withColumn("intercept", r(F.lit(model.intercept), 4))


query("flagship", """
WITH s AS (SELECT avg(o_custkey) AS m, stddev_pop(o_custkey) AS d FROM orders),
     x AS (SELECT (o_custkey - m) / d AS x, o_totalprice AS y FROM orders, s),
     f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_r2(y, x) AS r2 FROM x)
SELECT round(sqrt(avg((y - a - b * x) ** 2)), 4) AS rmse, round(avg(abs(y - a - b * x)), 4) AS mae, round(any_value(r2), 9) + 0.0 AS r2,
       count(*) AS support, round(any_value(b), 4) + 0.0 AS slope, round(any_value(a), 4) AS intercept FROM x, f""")(flagship)


@query("linear_regression_train", """
WITH s AS (SELECT count(*) AS n, var_pop(l_quantity) AS aa, var_pop(l_discount) AS dd, covar_pop(l_quantity, l_discount) AS ad,
                  covar_pop(l_quantity, l_extendedprice) AS ay, covar_pop(l_discount, l_extendedprice) AS dy, var_pop(l_extendedprice) AS yy,
                  avg(l_quantity) AS ma, avg(l_discount) AS md, avg(l_extendedprice) AS my FROM lineitem),
     w AS (SELECT *, (ay * dd - dy * ad) / (aa * dd - ad * ad) AS b1, (dy * aa - ay * ad) / (aa * dd - ad * ad) AS b2 FROM s)
SELECT round(b1, 4) AS b1, round(b2, 3) AS b2, round(my - b1 * ma - b2 * md, 3) AS intercept, round((b1 * ay + b2 * dy) / yy, 9) AS r2_score, n AS training_samples FROM w""")
def _(spark, sf):
    m = LinearRegression(["q", "d"], "y").fit(_lines(spark, sf))
    return _one(spark, dict(b1=m.coefficients[0], b2=m.coefficients[1], intercept=m.intercept, r2_score=m.r2_score, training_samples=m.training_samples),
                dict(b1=4, b2=3, intercept=3, r2_score=9))


@query("linear_regression_predict", """
WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders)
SELECT o_orderkey, round(a + b * o_custkey, 4) AS prediction FROM orders, f""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    out = LinearRegression("o_custkey", "o_totalprice").fit(orders).transform(orders)
    return out.select("o_orderkey", r("prediction", 4).alias("prediction"))


ONE_SQL = """
WITH s AS (SELECT count(*) AS n, covar_pop(l_quantity, l_extendedprice) AS c, var_pop(l_quantity) AS v, avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem),
     w AS (SELECT *, {w} AS w FROM s)
SELECT round(w, 4) + 0.0 AS coefficient, round(my - w * mx, 3) AS intercept, n AS training_samples FROM w"""
PENALTIES = {
    "ridge_train": (Ridge, dict(alpha=50000.0), "c * n / (v * n + 50000)"),
    "lasso_train": (Lasso, dict(alpha=300.0), "sign(c) * greatest(abs(c) - 300, 0) / v"),
    "elastic_net_train": (ElasticNet, dict(alpha=300.0, l1_ratio=0.4), "sign(c) * greatest(abs(c) - 120, 0) / (v + 180)"),
}
for _name, (_kind, _args, _w) in PENALTIES.items():
    @query(_name, ONE_SQL.format(w=_w))
    def _(spark, sf, kind=_kind, args=_args):
        m = kind("q", "y", **args).fit(_lines(spark, sf))
        return _one(spark, dict(coefficient=m.coefficients[0], intercept=m.intercept, training_samples=m.training_samples), dict(coefficient=4, intercept=3))


for _name in ("ridge", "lasso"):
    _kind, _args, _w = PENALTIES[f"{_name}_train"]

    @query(f"{_name}_fit_predict", ONE_SQL.format(w=_w).rsplit("SELECT", 1)[0] + """
SELECT p_partkey, round(my - w * mx + w * p_size, 3) AS prediction FROM part, w""")
    def _(spark, sf, kind=_kind, args=_args):
        out = kind("q", "y", **args).fit(_lines(spark, sf)).transform(table(spark, sf, "part").withColumn("q", F.col("p_size")))
        return out.select("p_partkey", r("prediction", 3).alias("prediction"))


@query("ridge_lasso_predict", "SELECT p_partkey, round(1.5 + 0.25 * p_size - 0.5 * p_retailprice, 6) + 0.0 AS prediction FROM part")
def _(spark, sf):
    model = LinearModel(cols=["p_size", "p_retailprice"], coefficients=[0.25, -0.5], intercept=1.5)
    return model.transform(table(spark, sf, "part")).select("p_partkey", r("prediction").alias("prediction"))


@query("elastic_net_predict", ONE_SQL.format(w="sign(c) * greatest(abs(c) - 120, 0) / (v + 180)").rsplit("SELECT", 1)[0] + """
SELECT p_partkey, round(my - w * mx + w * p_size, 3) AS prediction FROM part, w""")
def _(spark, sf):
    model = ElasticNet("q", "y", alpha=300.0, l1_ratio=0.4).fit(_lines(spark, sf))
    out = model.transform(table(spark, sf, "part").withColumn("q", F.col("p_size")))
    return out.select("p_partkey", r("prediction", 3).alias("prediction"))


LOGIT = dict(cols=["p", "c"], target="o_orderstatus", classes=["F", "O", "P"], coefficients=[[0.4, -0.3], [-0.2, 0.5], [0.1, 0.1]], intercept=[0.1, 0.0, -0.1])
LOGIT_SQL = """
WITH x AS (SELECT o_orderkey, o_totalprice / 100000 AS p, o_custkey / 1000 AS c FROM orders),
     z AS (SELECT o_orderkey, exp(0.1 + p * 0.4 - c * 0.3) AS f, exp(-p * 0.2 + c * 0.5) AS o, exp(-0.1 + p * 0.1 + c * 0.1) AS p FROM x)"""


@query("logistic_train")
def _(spark, sf):
    m = LogisticRegression(["p", "c"], "o_orderstatus").fit(_orders(spark, sf))
    rows = [(c, float(b), *map(float, w)) for c, w, b in zip(m.classes, m.coefficients, m.intercept)]
    out = spark.createDataFrame(rows, "class string, intercept double, w_p double, w_c double")
    return out.withColumn("accuracy", F.lit(m.accuracy)).withColumn("training_samples", F.lit(m.training_samples))


@query("logistic_predict", LOGIT_SQL + """
SELECT o_orderkey, CASE WHEN f >= o AND f >= p THEN 'F' WHEN o >= p THEN 'O' ELSE 'P' END AS prediction FROM z""")
def _(spark, sf):
    return LogisticModel(**LOGIT).transform(_orders(spark, sf)).select("o_orderkey", "prediction")


@query("logistic_predict_proba", LOGIT_SQL + """
SELECT o_orderkey, round(f / (f + o + p), 6) AS p_f, round(o / (f + o + p), 6) AS p_o, round(p / (f + o + p), 6) AS p_p FROM z""")
def _(spark, sf):
    out = LogisticModel(**LOGIT).transform(_orders(spark, sf))
    return out.select("o_orderkey", r(F.col("probabilities")[0]).alias("p_f"), r(F.col("class_probabilities")["O"]).alias("p_o"), r(F.col("probabilities")[2]).alias("p_p"))


NB_STATS = """
WITH x AS (SELECT o_orderkey, o_orderstatus AS c, o_totalprice / 100000 AS p, o_custkey / 1000 AS k FROM orders),
     g AS (SELECT c, count(*) AS n, avg(p) AS mp, avg(k) AS mk, var_pop(p) AS vp, var_pop(k) AS vk FROM x GROUP BY c),
     e AS (SELECT 1e-9 * greatest(var_pop(p), var_pop(k)) AS e, count(*) AS nn FROM x)"""


@query("gaussian_nb_train", NB_STATS + """
SELECT c AS class, n AS class_count, round(n / nn, 6) AS prior, round(mp, 6) AS mean_p, round(mk, 6) AS mean_c, round(vp + e, 6) AS var_p, round(vk + e, 6) AS var_c FROM g, e""")
def _(spark, sf):
    m = GaussianNB(["p", "c"], "o_orderstatus").fit(_orders(spark, sf))
    rows = [(c, n, q, *a, *b) for c, n, q, a, b in zip(m.classes, m.class_count, m.class_prior, m.theta, m.var)]
    out = spark.createDataFrame(rows, "class string, class_count long, prior double, mean_p double, mean_c double, var_p double, var_c double")
    return out.select("class", "class_count", *[r(c).alias(c) for c in out.columns[2:]])


def _argmax_sql(score, extra):
    return f""", j AS (SELECT o_orderkey, x.c AS truth, g.c, {score} AS s FROM x, g, e),
    b AS (SELECT o_orderkey, any_value(truth) AS truth, arg_max(c, s) AS prediction, max(s) AS top FROM j GROUP BY o_orderkey),
    z AS (SELECT o_orderkey, sum(exp(s - top)) AS z FROM j JOIN b USING (o_orderkey) GROUP BY o_orderkey) {extra}"""


@query("gaussian_nb_predict", NB_STATS + _argmax_sql(
    "ln(n / nn) - 0.5 * ln(2 * pi() * (vp + e)) - (p - mp) ** 2 / (2 * (vp + e)) - 0.5 * ln(2 * pi() * (vk + e)) - (k - mk) ** 2 / (2 * (vk + e))",
    "SELECT o_orderkey, prediction, round(1 / z, 6) AS probability FROM b JOIN z USING (o_orderkey)"))
def _(spark, sf):
    orders = _orders(spark, sf)
    out = GaussianNB(["p", "c"], "o_orderstatus", with_score=False).fit(orders).transform(orders)
    return out.select("o_orderkey", "prediction", r(F.array_max("probabilities")).alias("probability"))


MNB_STATS = """
WITH x AS (SELECT o_orderkey, o_orderstatus AS c, o_totalprice / 100000 AS p, o_custkey / 1000 AS k FROM orders),
     g AS (SELECT c, count(*) AS n, ln((sum(p) + 1) / (sum(p) + sum(k) + 2)) AS wp, ln((sum(k) + 1) / (sum(p) + sum(k) + 2)) AS wk FROM x GROUP BY c),
     e AS (SELECT count(*) AS nn FROM x)"""
BNB_STATS = """
WITH x AS (SELECT o_orderkey, o_orderstatus AS c, (o_totalprice > 250000)::INT AS p, (o_custkey > 700)::INT AS k FROM orders),
     g AS (SELECT c, count(*) AS n, (sum(p) + 1) / (count(*) + 2) AS qp, (sum(k) + 1) / (count(*) + 2) AS qk FROM x GROUP BY c),
     e AS (SELECT count(*) AS nn FROM x)"""


def _binary_orders(spark, sf):
    return _orders(spark, sf).select("o_orderkey", "o_orderstatus", (F.col("p") * 100000 - 250000).alias("p"), (F.col("c") * 1000 - 700).alias("c"))


@query("multinomial_nb_train", MNB_STATS + "SELECT c AS class, n AS class_count, round(wp, 6) AS log_p, round(wk, 6) AS log_c FROM g")
def _(spark, sf):
    m = MultinomialNB(["p", "c"], "o_orderstatus").fit(_orders(spark, sf))
    rows = [(c, n, *w) for c, n, w in zip(m.classes, m.class_count, m.log_prob)]
    out = spark.createDataFrame(rows, "class string, class_count long, log_p double, log_c double")
    return out.select("class", "class_count", r("log_p").alias("log_p"), r("log_c").alias("log_c"))


@query("multinomial_nb_predict", MNB_STATS + _argmax_sql("ln(n / nn) + p * wp + k * wk", "SELECT o_orderkey, prediction, round(1 / z, 6) AS probability FROM b JOIN z USING (o_orderkey)"))
def _(spark, sf):
    orders = _orders(spark, sf)
    out = MultinomialNB(["p", "c"], "o_orderstatus", with_score=False).fit(orders).transform(orders)
    return out.select("o_orderkey", "prediction", r(F.array_max("probabilities")).alias("probability"))


@query("bernoulli_nb_train", BNB_STATS + "SELECT c AS class, n AS class_count, round(ln(qp), 6) AS log_p, round(ln(qk), 6) AS log_c FROM g")
def _(spark, sf):
    m = BernoulliNB(["p", "c"], "o_orderstatus").fit(_binary_orders(spark, sf))
    rows = [(c, n, *w) for c, n, w in zip(m.classes, m.class_count, m.log_prob)]
    out = spark.createDataFrame(rows, "class string, class_count long, log_p double, log_c double")
    return out.select("class", "class_count", r("log_p").alias("log_p"), r("log_c").alias("log_c"))


@query("bernoulli_nb_predict", BNB_STATS + _argmax_sql(
    "ln(n / nn) + CASE WHEN p = 1 THEN ln(qp) ELSE ln(1 - qp) END + CASE WHEN k = 1 THEN ln(qk) ELSE ln(1 - qk) END",
    "SELECT o_orderkey, prediction, round(1 / z, 6) AS probability FROM b JOIN z USING (o_orderkey)"))
def _(spark, sf):
    orders = _binary_orders(spark, sf)
    out = BernoulliNB(["p", "c"], "o_orderstatus", with_score=False).fit(orders).transform(orders)
    return out.select("o_orderkey", "prediction", r(F.array_max("probabilities")).alias("probability"))


def _customers(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 1000).alias("a"), F.col("c_nationkey").alias("b"),
                                               F.col("c_mktsegment").alias("s"), F.col("c_acctbal").alias("y"))


def _suppliers(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_acctbal") / 1000).alias("a"), F.col("s_nationkey").alias("b"))


NN_SQL = """
WITH t AS (SELECT c_custkey AS id, c_acctbal / 1000 AS a, c_nationkey::DOUBLE AS b, c_mktsegment AS s, c_acctbal AS y FROM customer),
     q AS (SELECT {q}),
     d AS (SELECT q.id AS query, t.id AS neighbor, t.s, t.y, {dist} AS d FROM q, t),
     n AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, neighbor) AS rank FROM d QUALIFY rank <= 5)"""
EUCLID = "sqrt((q.a - t.a) ** 2 + (q.b - t.b) ** 2)"
SUPPLIER_Q = "s_suppkey AS id, s_acctbal / 1000 AS a, s_nationkey::DOUBLE AS b FROM supplier"
CUSTOMER_Q = "c_custkey AS id, c_acctbal / 1000 AS a, c_nationkey::DOUBLE AS b FROM customer"


@query("knn_classifier_predict", NN_SQL.format(q=SUPPLIER_Q, dist=EUCLID) + """,
v AS (SELECT query, s, count(*) AS votes FROM n GROUP BY ALL),
p AS (SELECT query, s AS prediction, votes FROM v QUALIFY row_number() OVER (PARTITION BY query ORDER BY votes DESC, s) = 1)
SELECT query AS id, prediction, round(votes / 5, 6) AS probability, (SELECT round(max(d), 6) FROM n WHERE n.query = p.query) AS farthest FROM p""")
def _(spark, sf):
    out = KNNClassifier(["a", "b"], "s", "id").fit(_customers(spark, sf)).transform(_suppliers(spark, sf))
    return out.select("id", "prediction", r(F.array_max("probabilities")).alias("probability"), r(F.element_at("neighbor_distances", -1)).alias("farthest"))


@query("knn_classifier_train", NN_SQL.format(q=CUSTOMER_Q, dist=EUCLID) + """,
v AS (SELECT query, s, count(*) AS votes FROM n GROUP BY ALL),
p AS (SELECT query, s FROM v QUALIFY row_number() OVER (PARTITION BY query ORDER BY votes DESC, s) = 1)
SELECT count(*) AS training_samples, (SELECT count(DISTINCT s) FROM t) AS n_classes, round(avg((p.s = t.s)::INT), 6) AS accuracy FROM p JOIN t ON t.id = p.query""")
def _(spark, sf):
    rows = _customers(spark, sf)
    model = KNNClassifier(["a", "b"], "s", "id").fit(rows)
    out = model.transform(rows)
    hit = F.when(F.col("prediction") == F.col("s"), 1.0).otherwise(0.0)
    return out.agg(F.count(F.lit(1)).alias("training_samples"), F.lit(len(model.classes)).cast("long").alias("n_classes"), r(F.avg(hit)).alias("accuracy"))


@query("knn_regressor_predict", NN_SQL.format(q=SUPPLIER_Q, dist="abs(q.a - t.a) + abs(q.b - t.b)") + """
SELECT query AS id, round(sum(y / d) / sum(1 / d), 4) + 0.0 AS prediction FROM n GROUP BY query""")
def _(spark, sf):
    out = KNNRegressor(["a", "b"], "y", "id", weights="distance", metric="manhattan").fit(_customers(spark, sf)).transform(_suppliers(spark, sf))
    return out.select("id", r("prediction", 4).alias("prediction"))


@query("knn_regressor_train", NN_SQL.format(q=CUSTOMER_Q, dist=EUCLID) + """,
p AS (SELECT query, avg(y) AS z FROM n GROUP BY query)
SELECT count(*) AS training_samples, round(1 - avg((y - z) ** 2) / var_pop(y), 6) AS r2_score FROM p JOIN t ON t.id = p.query""")
def _(spark, sf):
    rows = _customers(spark, sf)
    out = KNNRegressor(["a", "b"], "y", "id").fit(rows).transform(rows)
    return regression_metrics(out, "y", "prediction").select(F.col("support").alias("training_samples"), r("r2").alias("r2_score"))


VEC_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings),
     d AS (SELECT a.vec_id AS query, b.vec_id AS neighbor, {dist} AS d FROM v a, v b),
     n AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY d, neighbor) AS rank FROM d QUALIFY rank <= 6)"""


@query("knn_vectors_euclidean", VEC_SQL.format(dist="list_distance(a.e, b.e)") + "SELECT query, neighbor, round(d, 5) AS distance, rank FROM n WHERE query <> neighbor")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    found = KNNClassifier(["embedding"], "label", "vec_id", 6).fit(vectors).neighbors(vectors).where("query != neighbor")
    return found.select("query", "neighbor", r("distance", 5).alias("distance"), F.col("rank").cast("long").alias("rank"))


@query("knn_vectors_cosine", VEC_SQL.format(dist="1 - list_cosine_similarity(a.e, b.e)") + "SELECT query, neighbor, round(d, 5) AS distance FROM n WHERE query <> neighbor")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    found = KNNClassifier(["embedding"], "label", "vec_id", 6, metric="cosine").fit(vectors).neighbors(vectors).where("query != neighbor")
    return found.select("query", "neighbor", r("distance", 5).alias("distance"))


def _stump(gain, leaf, target):
    return f"""
WITH x AS (SELECT l_linenumber::DOUBLE AS ln, l_tax AS t, {target} AS y FROM lineitem),
     c AS (SELECT 'ln' AS f, (ln + lead(ln) OVER (ORDER BY ln)) / 2 AS cut FROM (SELECT DISTINCT ln FROM x)
           UNION ALL SELECT 't', (t + lead(t) OVER (ORDER BY t)) / 2 FROM (SELECT DISTINCT t FROM x)),
     s AS (SELECT f, cut, CASE f WHEN 'ln' THEN ln ELSE t END <= cut AS side, y FROM x, c WHERE cut IS NOT NULL),
     g AS ({gain}),
     b AS (SELECT f, cut FROM g ORDER BY gain DESC LIMIT 1),
     p AS (SELECT side, {leaf} AS prediction, count(*) AS n FROM s JOIN b USING (f, cut) GROUP BY side)"""


REG_STUMP = _stump("""SELECT f, cut, sum(q) AS gain FROM (SELECT f, cut, count(*) * avg(y) * avg(y) AS q FROM s GROUP BY f, cut, side) GROUP BY f, cut""", "avg(y)", "l_quantity")
CLS_STUMP = _stump("""SELECT f, cut, sum(q) AS gain FROM (SELECT f, cut, sum(k * k) / sum(k) AS q FROM (SELECT f, cut, side, y, count(*) AS k FROM s GROUP BY ALL) GROUP BY f, cut, side)
     GROUP BY f, cut""", "mode(y)", "l_returnflag")


@query("decision_tree_regressor_train", REG_STUMP + "SELECT 1 AS depth, 2 AS leaves, sum(n)::BIGINT AS training_samples FROM p")
def _(spark, sf):
    m = DecisionTreeRegressor(["ln", "t"], "q", max_depth=1).fit(_lines(spark, sf))
    return _one(spark, dict(depth=m.depth, leaves=m.leaves, training_samples=m.training_samples))


@query("decision_tree_regressor_predict", REG_STUMP + "SELECT round(prediction, 6) AS prediction, n FROM p")
def _(spark, sf):
    lines = _lines(spark, sf, heavy=True)
    out = DecisionTreeRegressor(["ln", "t"], "q", max_depth=1, with_score=False).fit(lines).transform(lines)
    return out.groupBy(r("prediction").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("gbt_regressor_stump", REG_STUMP + "SELECT round(prediction, 6) AS prediction, n FROM p")
def _(spark, sf):
    lines = _lines(spark, sf, heavy=True)
    out = GradientBoostingRegressor(["ln", "t"], "q", n_estimators=1, max_depth=1, with_score=False).fit(lines).transform(lines)
    return out.groupBy(r("prediction").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("decision_tree_classifier_train", CLS_STUMP + "SELECT 1 AS depth, 2 AS leaves, sum(n)::BIGINT AS training_samples FROM p")
def _(spark, sf):
    m = DecisionTreeClassifier(["ln", "t"], "f", max_depth=1).fit(_lines(spark, sf))
    return _one(spark, dict(depth=m.depth, leaves=m.leaves, training_samples=m.training_samples))


@query("decision_tree_classifier_predict", CLS_STUMP + "SELECT prediction, sum(n)::BIGINT AS n FROM p GROUP BY 1")
def _(spark, sf):
    lines = _lines(spark, sf, heavy=True)
    out = DecisionTreeClassifier(["ln", "t"], "f", max_depth=1, with_score=False).fit(lines).transform(lines)
    return out.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


def _summary(spark, model):
    return model.summary(spark)


def _histogram(out, digits=1):
    kind = dict(out.dtypes)["prediction"]
    key = r("prediction", digits) if kind == "double" else F.col("prediction")
    return out.groupBy(key.alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


FEATURES = ["q", "d", "t", "ln"]
TREE_MODELS = {
    "random_forest_regressor": lambda: RandomForestRegressor(FEATURES, "y", n_estimators=10, max_depth=5),
    "gbt_regressor": lambda: GradientBoostingRegressor(FEATURES, "y", n_estimators=5, max_depth=3),
    "random_forest_classifier": lambda: RandomForestClassifier(FEATURES, "f", n_estimators=10, max_depth=5),
    "gbt_classifier": lambda: GradientBoostingClassifier(FEATURES, "f", n_estimators=3, max_depth=2),
}
for _name, _make in TREE_MODELS.items():
    @query(f"{_name}_train")
    def _(spark, sf, build=_make):
        return _summary(spark, build().fit(_lines(spark, sf, heavy=True)))

    @query(f"{_name}_predict")
    def _(spark, sf, build=_make):
        op = build()
        op.with_score = False
        lines = _lines(spark, sf, heavy=True)
        return _histogram(op.fit(lines).transform(lines), 0)


def _small(spark, sf):
    """One row per customer: scaled balance and nation, order count and mean price (both 0 without orders)."""
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.avg("o_totalprice").alias("p"))
    rows = table(spark, sf, "customer").join(per, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0, ["n", "p"])
    return rows.select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 5000).alias("a"), (F.col("c_nationkey") / 12 - 1).alias("b"),
                       (F.col("n") / 10 - 1).alias("n"), (F.col("p") / 100000 - 2.5).alias("p"), (F.col("c_acctbal") > 4500).cast("int").alias("rich"))


SMALL = ["b", "n", "p"]
OTHER_MODELS = {
    "svr": lambda: SVR([*SMALL], "a", kernel="rbf", features=50, max_iter=15),
    "svc": lambda: SVC(["a", *SMALL], "rich", kernel="rbf", features=50, max_iter=20),
    "mlp_regressor": lambda: MLPRegressor(["b", "n", "p"], "a", hidden="8,4", solver="lbfgs", max_iter=10),
    "mlp_classifier": lambda: MLPClassifier(["a", *SMALL], "rich", hidden="8", activation="tanh", max_iter=15, learning_rate=0.05),
}
for _name, _make in OTHER_MODELS.items():
    @query(f"{_name}_train")
    def _(spark, sf, build=_make):
        m = build().fit(_small(spark, sf))
        keep = ("accuracy", "r2_score", "training_samples", "n_support", "iterations", "loss")
        return _one(spark, {k: v for k, v in m.state.items() if k in keep})

    @query(f"{_name}_predict")
    def _(spark, sf, build=_make):
        op = build()
        op.with_score = False
        rows = _small(spark, sf)
        return op.fit(rows).transform(rows).select("id", "prediction")
for _kernel in ("linear", "poly", "sigmoid"):
    @query(f"svc_{_kernel}")
    def _(spark, sf, kernel=_kernel):
        rows = _small(spark, sf)
        out = SVC(["a", *SMALL], "rich", kernel=kernel, features=50, max_iter=10, with_score=False).fit(rows).transform(rows)
        return out.select("id", "prediction", r(F.col("probabilities")[1], 4).alias("probability"))


@query("mlp_classifier_logistic")
def _(spark, sf):
    rows = _small(spark, sf)
    out = MLPClassifier(["a", *SMALL], "rich", hidden="6", activation="logistic", solver="lbfgs", max_iter=30, with_score=False).fit(rows).transform(rows)
    return out.select("id", "prediction", r(F.col("probabilities")[1], 4).alias("probability"))

"""Monotone calibration, grown trees, and clusterings whose result has a closed form."""

from __future__ import annotations

from tablelearn.operators.cluster import MeanShift, agglomerative, spectral
from tablelearn.operators.decompose import SparseTruncatedSVD
from tablelearn.operators.ensemble import CalibratedClassifier
from tablelearn.operators.kernel_machines import KernelSVC
from tablelearn.operators.linear import LogisticRegression
from tablelearn.operators.tfidf import HashedTfidf
from tablelearn.operators.trees import DecisionTreeClassifier, DecisionTreeRegressor
from tablelearn.plans.lineage import checkpointed
from tablelearn.plans.monotone import curve_pieces, interpolated, monotone_pools

from .base import F, query, r, spread, table
from .features import SVD_SQL
from .models import _customers

# The monotone fit by its definition: the largest over all starts of the least over all ends of the mean between them.
MONOTONE = """
c AS (SELECT {key} x, w, y, row_number() OVER ({part} ORDER BY x) AS i, sum(w) OVER ({part} ORDER BY x) AS sw, sum(y) OVER ({part} ORDER BY x) AS sy FROM p),
low AS (SELECT {a} a.i AS i, min((b.sy - a.sy + a.y) / (b.sw - a.sw + a.w)) OVER ({apart} a.i ORDER BY b.i DESC) AS m, b.i AS upto FROM c a JOIN c b ON {ab} b.i >= a.i),
fit AS (SELECT {c} c.x, max(low.m) AS v FROM c JOIN low ON {cl} low.i <= c.i AND low.upto = c.i GROUP BY ALL)"""


def _monotone(key=""):
    if not key:
        return MONOTONE.format(key="", part="", a="", apart="PARTITION BY", ab="", c="", cl="")
    return MONOTONE.format(key=f"{key},", part=f"PARTITION BY {key}", a=f"a.{key},", apart=f"PARTITION BY a.{key},", ab=f"a.{key} = b.{key} AND", c=f"c.{key},", cl=f"low.{key} = c.{key} AND")


@query("isotonic_fit", f"""
WITH p AS (SELECT l_quantity AS x, count(*)::DOUBLE AS w, sum((l_returnflag = 'R')::INT)::DOUBLE AS y FROM lineitem GROUP BY 1), {_monotone()}
SELECT x AS quantity, round(v, 9) AS share FROM fit""")
def _(spark, sf):
    """The share of returned lines as a rising function of the quantity."""
    lines = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), F.lit(1.0).alias("w"), F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("t"))
    pieces = curve_pieces(monotone_pools(lines))
    out = interpolated(lines.select(F.col("x").alias("quantity")).distinct(), "quantity", pieces, "share")
    return out.select("quantity", r("share", 9).alias("share"))


@query("calibrated_isotonic", f"""
WITH x AS (SELECT c_custkey AS id, (c_nationkey % 5)::DOUBLE AS a, c_acctbal > 5000 AS t,
                  ntile(3) OVER (PARTITION BY c_acctbal > 5000 ORDER BY md5(c_custkey || '-42')) - 1 AS f FROM customer),
     k AS (SELECT unnest(range(3)) AS fold),
     g AS (SELECT fold, t, count(*) AS n, avg(a) AS m, var_pop(a) AS v FROM x, k WHERE f <> fold GROUP BY ALL),
     e AS (SELECT fold, 1e-9 * var_pop(a) AS e, count(*) AS nn FROM x, k WHERE f <> fold GROUP BY fold),
     z AS (SELECT fold, a, t, ln(n / nn) - 0.5 * ln(2 * pi() * (v + e)) - (a - m) ** 2 / (2 * (v + e)) AS l FROM (SELECT DISTINCT a FROM x), g JOIN e USING (fold)),
     s AS (SELECT fold, a, 1 / (1 + exp(max(l) FILTER (NOT t) - max(l) FILTER (t))) AS s FROM z GROUP BY ALL),
     p AS (SELECT fold, s AS x, count(*)::DOUBLE AS w, sum(t::INT)::DOUBLE AS y FROM x JOIN s ON s.fold = f AND s.a = x.a GROUP BY ALL), {_monotone("fold")}
SELECT id, avg(v) > 0.5 AS prediction, round(avg(v), 6) AS probability FROM x JOIN s ON s.a = x.a JOIN fit ON fit.fold = s.fold AND fit.x = s.s GROUP BY id""")
def _(spark, sf):
    """Five different scores, so that the monotone curves of the three folds can be written down."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") % 5).cast("double").alias("a"), (F.col("c_acctbal") > 5000).alias("rich"))
    out = CalibratedClassifier(["a"], "rich", "id", base="GaussianNB", method="isotonic", cv=3).fit(rows).transform(rows)
    return out.select("id", "prediction", r(F.col("calibrated_probabilities")[1]).alias("probability"))


TREE_X = "x AS (SELECT floor(l_extendedprice / 2000) AS f0, l_linenumber::DOUBLE AS f1, {y} AS y FROM lineitem)"
COSTS = {  # impurity times rows of a group of rows
    "squared_error": "sum(y * y) - sum(y) ** 2 / count(*)",
    "friedman_mse": "sum(y * y) - sum(y) ** 2 / count(*)",
    "poisson": "-sum(y) * ln(sum(y) / count(*))",
    "absolute_error": "sum(abs(y - mid))",
    "gini": "count(*) * (1 - (sum(y) / count(*)) ** 2 - (1 - sum(y) / count(*)) ** 2)",
}


def _tree_sql(criterion, y, min_split=2, min_leaf=1):
    """Two levels: all cuts of all columns are tried on the rows themselves."""
    cost, median = COSTS[criterion], "median(y)" if criterion == "absolute_error" else "avg(y)"

    def level(k):
        return f"""
side{k} AS (SELECT node, j, t, CASE j WHEN 0 THEN f0 ELSE f1 END > t AS beyond, y FROM r{k}, cuts),
mid{k} AS (SELECT node, j, t, beyond, y, {'median(y) OVER (PARTITION BY node, j, t, beyond)' if criterion == 'absolute_error' else 'y'} AS mid FROM side{k}),
cost{k} AS (SELECT node, j, t, beyond, count(*) AS n, {cost} AS cost FROM mid{k} GROUP BY ALL),
best{k} AS (SELECT node, j, t FROM cost{k} GROUP BY node, j, t HAVING count(*) = 2 AND min(n) >= {min_leaf} AND sum(n) >= {min_split}
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(sum(cost), 5), j, t) = 1),
r{k + 1} AS (SELECT node * 2 + (CASE j WHEN 0 THEN f0 ELSE f1 END > t)::INT AS node, f0, f1, y FROM r{k} JOIN best{k} USING (node))"""

    value = "avg(y)" if criterion != "absolute_error" else "any_value(mid)"
    node = f"""SELECT node, count(*) AS n, ({cost}) / count(*) AS impurity, {value} AS value FROM (SELECT node, y, {'median(y) OVER (PARTITION BY node)' if criterion == 'absolute_error' else 'y'} AS mid FROM (
        SELECT node, y FROM r0 UNION ALL SELECT node, y FROM r1 UNION ALL SELECT node, y FROM r2)) GROUP BY node"""
    return f"""
WITH {TREE_X.format(y=y)},
cuts AS (SELECT 0 AS j, (v + lead(v) OVER (ORDER BY v)) / 2 AS t FROM (SELECT DISTINCT f0 AS v FROM x) QUALIFY lead(v) OVER (ORDER BY v) IS NOT NULL UNION ALL
         SELECT 1, (v + lead(v) OVER (ORDER BY v)) / 2 FROM (SELECT DISTINCT f1 AS v FROM x) QUALIFY lead(v) OVER (ORDER BY v) IS NOT NULL),
r0 AS (SELECT 1::BIGINT AS node, f0, f1, y FROM x), {level(0)}, {level(1)},
splits AS (SELECT * FROM best0 UNION ALL SELECT * FROM best1), nodes AS ({node})
SELECT node AS id, n, round(impurity, 5) + 0.0 AS impurity, round(value, 6) AS value, 'f' || j AS feature, t AS threshold FROM nodes LEFT JOIN splits USING (node)"""


def _tree_rows(spark, sf, target):
    return table(spark, sf, "lineitem").select(F.floor(F.col("l_extendedprice") / 2000).cast("double").alias("f0"), F.col("l_linenumber").cast("double").alias("f1"), target.alias("y"))


def _node_rows(spark, model):
    return model.node_table(spark).select("id", "n", r("impurity", 5).alias("impurity"), r("value").alias("value"), "feature", "threshold")


for _criterion in ("friedman_mse", "absolute_error", "poisson"):
    @query(f"decision_tree_{_criterion}", _tree_sql(_criterion, "l_quantity"))
    def _(spark, sf, criterion=_criterion):
        rows = _tree_rows(spark, sf, F.col("l_quantity"))
        return _node_rows(spark, DecisionTreeRegressor(["f0", "f1"], "y", 2, criterion=criterion, with_score=False).fit(rows))


@query("decision_tree_min_split", _tree_sql("squared_error", "l_quantity", 25_000, 300))
def _(spark, sf):
    rows = _tree_rows(spark, sf, F.col("l_quantity"))
    return _node_rows(spark, DecisionTreeRegressor(["f0", "f1"], "y", 2, min_samples_split=25_000, min_samples_leaf=300, with_score=False).fit(rows))


@query("decision_tree_gini_min_split", _tree_sql("gini", "(l_quantity > 30)::INT", 20_000, 300))
def _(spark, sf):
    rows = _tree_rows(spark, sf, (F.col("l_quantity") > 30).cast("int"))
    model = DecisionTreeClassifier(["f0", "f1"], "y", 2, min_samples_split=20_000, min_samples_leaf=300, with_score=False).fit(rows)
    out = [(n["id"], n["n"], n["impurity"], n["value"][1], f"f{n['feature']}" if "feature" in n else None, n.get("threshold")) for n in model.nodes]
    return spark.createDataFrame(out, "id long, n long, impurity double, value double, feature string, threshold double").withColumns({"impurity": r("impurity", 5), "value": r("value")})


# Customers lie around a place of their region, the regions far apart: as many clusters as regions.
REGION_X = """x AS (SELECT c_custkey AS id, n_regionkey * 40 + (c_custkey % 7) / 7.0 AS a, n_regionkey * n_regionkey * 10 + c_acctbal / 10000 AS b, n_regionkey AS g
                     FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _regions(spark, sf):
    both = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    g = F.col("n_regionkey")
    return both.select(F.col("c_custkey").alias("id"), (g * 40 + (F.col("c_custkey") % 7) / 7.0).alias("a"), (g * g * 10 + F.col("c_acctbal") / 10000).alias("b"))


BY_FIRST = f"""
WITH {REGION_X}, first AS (SELECT g, min(id) AS m FROM x GROUP BY g)
SELECT id, (dense_rank() OVER (ORDER BY m) - 1)::INT AS cluster FROM x JOIN first USING (g)"""


@query("agglomerative_ward_regions", BY_FIRST)
def _(spark, sf):
    return agglomerative(_regions(spark, sf), "id", ["a", "b"], table(spark, sf, "region").count(), "ward").select("id", "cluster")


@query("spectral_rbf_regions", BY_FIRST)
def _(spark, sf):
    return spectral(_regions(spark, sf), "id", ["a", "b"], table(spark, sf, "region").count(), "rbf", gamma=0.01, n_init=3).select("id", "cluster")


@query("mean_shift_regions", f"""
WITH {REGION_X}, m AS (SELECT g, count(*) AS n, avg(a) AS a, avg(b) AS b FROM x GROUP BY g),
     o AS (SELECT g, (row_number() OVER (ORDER BY n DESC, a DESC, b DESC) - 1)::INT AS cluster FROM m)
SELECT id, cluster, (SELECT count(*) FROM m)::INT AS n_clusters FROM x JOIN o USING (g)""")
def _(spark, sf):
    """A ball of 3 around any customer holds its whole region and nothing else, so the modes are the regions' means."""
    rows = _regions(spark, sf)
    return MeanShift(["a", "b"], "id", bandwidth=3.0, bin_seeding=True).fit(rows).transform(rows).select("id", "cluster", "n_clusters")


@query("agglomerative_ward")
def _(spark, sf):
    """Exact Ward merging of all customers; tests hold it against the full distance matrix."""
    rows = _customers(spark, sf).select("id", (F.col("y") / 100).alias("a"), "b")
    return agglomerative(rows, "id", ["a", "b"], 4, "ward").select("id", "cluster")


@query("spectral_rbf")
def _(spark, sf):
    return spectral(table(spark, sf, "embeddings"), "vec_id", ["embedding"], 3, "rbf", gamma=1.0, n_init=3).select("vec_id", "cluster")


@query("tsvd_sparse", SVD_SQL + """
SELECT p_partkey, round(p_size * x1 + p_retailprice * x2, 4) + 0.0 AS svd_component_1, round(sqrt(l1), 4) AS s1, round(sqrt(l2), 4) AS s2 FROM part, p""")
def _(spark, sf):
    """Two columns far apart among many that are empty: the vectors are those of the narrow form."""
    far = F.create_map(F.lit(7), F.col("p_size").cast("double"), F.lit(2_000_000_000), F.col("p_retailprice").cast("double"))
    rows = table(spark, sf, "part").select("p_partkey", far.alias("row"))
    out, m = SparseTruncatedSVD("row", 2).fit_transform(rows)
    sizes = [r(F.lit(s), 4).alias(f"s{i + 1}") for i, s in enumerate(m.singular_values)]
    return out.select("p_partkey", r(F.col("svd_features")[0], 4).alias("svd_component_1"), *sizes)


TERM_ROUNDS = 60


@query("tsvd_terms", f"""
WITH RECURSIVE t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM documents),
c AS (SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 262144 AS b, count(*) AS n FROM t GROUP BY ALL),
f AS (SELECT b, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))::DOUBLE) + 1 AS idf FROM c GROUP BY b),
w AS MATERIALIZED (SELECT doc_id, b, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc_id)) AS w FROM c JOIN f USING (b)),
it AS (SELECT 0 AS n, b, 1.0::DOUBLE AS v FROM f
  UNION ALL
  SELECT n, b, v / sqrt(sum(v * v) OVER ()) FROM (
    SELECT max(u.n) + 1 AS n, w.b, sum(w.w * u.u) AS v
    FROM (SELECT it.n, doc_id, sum(w * v) AS u FROM it JOIN w USING (b) WHERE it.n < {TERM_ROUNDS} GROUP BY ALL) u JOIN w USING (doc_id) GROUP BY w.b)),
s AS (SELECT doc_id, sum(w * v) AS x FROM w JOIN it USING (b) WHERE it.n = {TERM_ROUNDS} GROUP BY doc_id)
SELECT doc_id, round(coalesce(x, 0), 4) + 0.0 AS svd_component_1, (SELECT round(sqrt(sum(x * x)), 4) FROM s) AS s1 FROM documents LEFT JOIN s USING (doc_id)""")
def _(spark, sf):
    """The first component of hashed TF-IDF rows with 262,144 columns."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    rows = checkpointed(HashedTfidf("text").fit(docs).transform(docs).select("doc_id", "tfidf_row"))
    out, m = SparseTruncatedSVD("tfidf_row", 1).fit_transform(rows)
    return out.select("doc_id", r(F.col("svd_features")[0], 4).alias("svd_component_1"), r(F.lit(m.singular_values[0]), 4).alias("s1"))


@query("svc_support", """
WITH side AS (SELECT max(l_quantity) FILTER (WHERE l_quantity <= 25) AS low, min(l_quantity) FILTER (WHERE l_quantity > 25) AS high FROM lineitem)
SELECT l_quantity AS quantity, count(*) AS n, round(2 * (l_quantity - (low + high) / 2) / (high - low), 0) + 0.0 AS decision, l_quantity IN (low, high) AS support
FROM lineitem, side GROUP BY ALL""")
def _(spark, sf):
    """Two classes that one number parts: the machine lies halfway between the nearest rows, which alone support it."""
    lines = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("double").alias("q"), (F.col("l_quantity") > 25).cast("int").alias("t"))
    model = KernelSVC(["q"], "t", kernel="linear", C=0.1, with_score=False).fit(lines)
    per = model.transform(lines).groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.first("decision")[0].alias("d"))
    held = model.support_vectors(lines).select("q").distinct().withColumn("support", F.lit(True))
    out = per.join(held, "q", "left")
    return out.select(F.col("q").alias("quantity"), "n", r("d", 0).alias("decision"), F.coalesce("support", F.lit(False)).alias("support"))


LOGIT_ROUNDS = 12


@query("logistic_train_binary", f"""
WITH RECURSIVE x AS MATERIALIZED (SELECT o_totalprice / 100000 AS p, (o_orderstatus = 'F')::INT AS y FROM orders),
it AS (SELECT 0 AS n, 0.0::DOUBLE AS w, 0.0::DOUBLE AS b
  UNION ALL
  SELECT n + 1, w - (hbb * gw - hwb * gb) / (hww * hbb - hwb * hwb), b - (hww * gb - hwb * gw) / (hww * hbb - hwb * hwb) FROM (
    SELECT any_value(n) AS n, any_value(w) AS w, any_value(b) AS b, sum((q - y) * p) + any_value(w) AS gw, sum(q - y) AS gb,
           sum(q * (1 - q) * p * p) + 1 AS hww, sum(q * (1 - q) * p) AS hwb, sum(q * (1 - q)) AS hbb
    FROM (SELECT it.*, p, y, 1 / (1 + exp(-(w * p + b))) AS q FROM it, x WHERE it.n < {LOGIT_ROUNDS})) WHERE n IS NOT NULL)
SELECT round(w, 3) + 0.0 AS weight, round(b, 3) + 0.0 AS intercept, (SELECT count(*) FROM x) AS training_samples FROM it WHERE n = {LOGIT_ROUNDS}""")
def _(spark, sf):
    """Penalised logistic regression on one number, against Newton's steps."""
    rows = table(spark, sf, "orders").select((F.col("o_totalprice") / 100000).alias("p"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    m = LogisticRegression(["p"], "y", tol=1e-10, with_score=False).fit(rows)
    out = spark.createDataFrame([(float(m.coefficients[0][0]), float(m.intercept[0]), m.training_samples)], "weight double, intercept double, training_samples long")
    return out.select(r("weight", 3).alias("weight"), r("intercept", 3).alias("intercept"), "training_samples")

"""Splits, folds, metrics and scorers."""

from __future__ import annotations

from tablelearn.operators.metrics import (
    classification_metrics, classification_report, clustering_metrics, confusion_matrix, regression_metrics, roc_auc, score,
)
from tablelearn.operators.split import with_folds, with_split

from .base import F, query, r, table

HASH = "md5({id} || '-42')"


@query("train_test_split", """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY md5(o_orderkey || '-42')) <= (SELECT ceil(0.2 * count(*)) FROM orders)
       THEN 'test' ELSE 'train' END AS _split FROM orders""")
def _(spark, sf):
    return with_split(table(spark, sf, "orders"), "o_orderkey", 0.2).select("o_orderkey", "_split")


@query("train_test_split_ordered", """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY event_id DESC) <= (SELECT ceil(0.25 * count(*)) FROM events)
       THEN 'test' ELSE 'train' END AS _split FROM events""")
def _(spark, sf):
    return with_split(table(spark, sf, "events"), "event_id", 0.25, shuffle=False).select("event_id", "_split")


@query("train_test_split_stratified", """
WITH c AS (SELECT c_mktsegment AS s, count(*) AS n FROM customer GROUP BY 1),
     f AS (SELECT s, n, floor(round(n * 0.3, 9)) AS base, round(n * 0.3 - floor(round(n * 0.3, 9)), 9) AS rest FROM c),
     k AS (SELECT s, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, s) <= (SELECT ceil(round(0.3 * sum(n), 9)) - sum(base) FROM f)
                  THEN 1 ELSE 0 END AS take FROM f)
SELECT c_custkey, CASE WHEN row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(c_custkey || '-42')) <= take THEN 'test' ELSE 'train' END AS _split
FROM customer JOIN k ON s = c_mktsegment""")
def _(spark, sf):
    return with_split(table(spark, sf, "customer"), "c_custkey", 0.3, stratify="c_mktsegment").select("c_custkey", "_split")


@query("folds_kfold", "SELECT o_orderkey, (ntile(5) OVER (ORDER BY md5(o_orderkey || '-42')) - 1)::INT AS _fold FROM orders")
def _(spark, sf):
    return with_folds(table(spark, sf, "orders"), "o_orderkey", 5).select("o_orderkey", "_fold")


@query("folds_stratified", """
SELECT o_orderkey, (ntile(4) OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey || '-42')) - 1)::INT AS _fold FROM orders""")
def _(spark, sf):
    return with_folds(table(spark, sf, "orders"), "o_orderkey", 4, "o_orderstatus").select("o_orderkey", "_fold")


PRED_SQL = "CASE WHEN l_linenumber % 3 = 0 THEN 'A' WHEN l_linenumber % 3 = 1 THEN 'N' ELSE 'R' END"
CLASS_SQL = f"""
WITH x AS (SELECT l_returnflag AS t, {PRED_SQL} AS p FROM lineitem),
     c AS (SELECT DISTINCT t AS c FROM x UNION SELECT DISTINCT p FROM x),
     g AS (SELECT c, sum((t = c)::INT) AS support, sum((p = c)::INT) AS predicted, sum((t = c AND p = c)::INT) AS tp FROM c, x GROUP BY c),
     m AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS pr, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS re FROM g),
     f AS (SELECT *, CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END AS f1 FROM m)"""


def _flags(spark, sf):
    k = F.col("l_linenumber") % 3
    return table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("t"), F.when(k == 0, "A").when(k == 1, "N").otherwise("R").alias("p"),
        (F.col("l_linestatus") == "O").cast("int").alias("b"), (F.col("l_quantity") > 25).cast("int").alias("bp"), "l_quantity", "l_extendedprice")


AVERAGES = {
    "weighted": ("sum({m} * support) / sum(support)",) * 3, "macro": ("avg({m})",) * 3, "micro": ("sum(tp) / sum(support)",) * 3,
}
for _avg, _forms in AVERAGES.items():
    @query("metrics_classification" if _avg == "weighted" else f"metrics_classification_{_avg}", CLASS_SQL + f"""
    SELECT round(sum(tp) / sum(support), 6) AS accuracy, round({_forms[0].format(m='pr')}, 6) AS precision, round({_forms[1].format(m='re')}, 6) AS recall,
           round({_forms[2].format(m='f1')}, 6) AS f1, sum(support)::BIGINT AS support, count(*) AS n_classes, '{_avg}' AS average_used FROM f""")
    def _(spark, sf, average=_avg):
        m = classification_metrics(_flags(spark, sf), "t", "p", average)
        return m.select(*[r(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "support", "n_classes", "average_used")


@query("metrics_classification_binary", """
WITH x AS (SELECT (l_linestatus = 'O')::INT AS t, (l_quantity > 25)::INT AS p FROM lineitem),
     g AS (SELECT count(*) AS n, sum((t = p)::INT) AS hit, sum(t * p) AS tp, sum(p) AS pp, sum(t) AS tt FROM x)
SELECT round(hit / n, 6) AS accuracy, round(tp / pp, 6) AS precision, round(tp / tt, 6) AS recall, round(2 * tp / (pp + tt), 6) AS f1,
       n AS support, 2::BIGINT AS n_classes, 'binary' AS average_used FROM g""")
def _(spark, sf):
    m = classification_metrics(_flags(spark, sf), "b", "bp", "binary")
    return m.select(*[r(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "support", "n_classes", "average_used")


@query("metrics_classification_report", CLASS_SQL + """
SELECT c AS class, support::BIGINT AS support, predicted::BIGINT AS predicted, round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1 FROM f""")
def _(spark, sf):
    m = classification_report(_flags(spark, sf), "t", "p")
    return m.select("class", "support", "predicted", *[r(c).alias(c) for c in ("precision", "recall", "f1")])


@query("metrics_confusion_matrix", CLASS_SQL + """
SELECT a.c AS true_class, b.c AS predicted_class, (SELECT count(*) FROM x WHERE t = a.c AND p = b.c) AS n FROM c a, c b""")
def _(spark, sf):
    m = confusion_matrix(_flags(spark, sf), "t", "p")
    classes = F.array(*[F.lit(c) for c in "ANR"])
    return m.select("true_class", F.explode(F.arrays_zip(classes.alias("c"), "counts")).alias("e")).select("true_class", F.col("e.c").alias("predicted_class"), F.col("e.counts").alias("n"))


REG_SQL = """
WITH x AS (SELECT l_extendedprice AS y, l_quantity * 1000 AS z, l_extendedprice - l_quantity * 1000 AS e FROM lineitem)"""


@query("metrics_regression", REG_SQL + """
SELECT round(avg(e * e), 0) AS mse, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae, round(1 - avg(e * e) / var_pop(y), 6) AS r2,
       round(avg(abs(e) / abs(y)), 6) AS mape, round(1 - var_pop(e) / var_pop(y), 6) AS explained_variance, count(*) AS support FROM x""")
def _(spark, sf):
    m = regression_metrics(_flags(spark, sf).withColumn("z", F.col("l_quantity") * 1000), "l_extendedprice", "z")
    return m.select(r("mse", 0).alias("mse"), r("rmse", 4).alias("rmse"), r("mae", 4).alias("mae"), *[r(c).alias(c) for c in ("r2", "mape", "explained_variance")], "support")


CLUSTER_COMMON = """
WITH x AS (SELECT c_custkey AS id, c_acctbal / 1000 AS a, c_nationkey::DOUBLE AS b,
                  CASE WHEN c_acctbal < 2000 THEN 0 WHEN c_acctbal < 6000 THEN 1 ELSE 2 END AS c FROM customer),
     g AS (SELECT c, count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_pop(a) + var_pop(b) AS v FROM x GROUP BY c),
     t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * ma) / sum(n) AS oa, sum(n * mb) / sum(n) AS ob, sum(n * v) AS w FROM g),
     ch AS (SELECT sum(n * ((ma - oa) ** 2 + (mb - ob) ** 2)) * (any_value(nn) - any_value(k)) / (any_value(w) * (any_value(k) - 1)) AS ch FROM g, t),
     s AS (SELECT c, avg(sqrt((a - ma) ** 2 + (b - mb) ** 2)) AS s FROM x JOIN g USING (c) GROUP BY c),
     db AS (SELECT avg(m) AS db FROM (SELECT p.c, max((sp.s + sq.s) / sqrt((p.ma - q.ma) ** 2 + (p.mb - q.mb) ** 2)) AS m
            FROM g p JOIN g q ON p.c <> q.c JOIN s sp ON sp.c = p.c JOIN s sq ON sq.c = q.c GROUP BY p.c)),
     d AS (SELECT p.id, p.c AS own, q.c AS other, sum({dist}) AS s FROM x p, x q GROUP BY ALL),
     ab AS (SELECT d.id, max(CASE WHEN own = other THEN d.s / greatest(g.n - 1, 1) END) AS i, min(CASE WHEN own <> other THEN d.s / g.n END) AS o
            FROM d JOIN g ON g.c = d.other GROUP BY d.id)"""


def _clusters(spark, sf):
    b = F.col("c_acctbal")
    return table(spark, sf, "customer").select("c_custkey", (b / 1000).alias("a"), F.col("c_nationkey").alias("b"), F.when(b < 2000, 0).when(b < 6000, 1).otherwise(2).alias("c"))


@query("metrics_clustering", CLUSTER_COMMON.format(dist="sqrt((p.a - q.a) ** 2 + (p.b - q.b) ** 2)") + """
SELECT round(ch, 4) AS calinski_harabasz, round(db, 6) AS davies_bouldin, (SELECT count(*) FROM g) AS n_clusters, (SELECT nn::BIGINT FROM t) AS support,
       (SELECT round(avg((o - i) / greatest(o, i)), 6) FROM ab) AS silhouette FROM ch, db""")
def _(spark, sf):
    m = clustering_metrics(_clusters(spark, sf), ["a", "b"], "c", "c_custkey")
    return m.select(r("calinski_harabasz", 4).alias("calinski_harabasz"), r("davies_bouldin").alias("davies_bouldin"), "n_clusters", "support", r("silhouette").alias("silhouette"))


@query("metrics_clustering_squared", CLUSTER_COMMON.format(dist="(p.a - q.a) ** 2 + (p.b - q.b) ** 2") + """
SELECT round(ch, 4) AS calinski_harabasz, (SELECT round(avg((o - i) / greatest(o, i)), 6) FROM ab) AS silhouette_squared FROM ch""")
def _(spark, sf):
    m = clustering_metrics(_clusters(spark, sf), ["a", "b"], "c", silhouette="squared")
    return m.select(r("calinski_harabasz", 4).alias("calinski_harabasz"), r("silhouette_squared").alias("silhouette_squared"))


SCORE_FORMS = {
    "accuracy": CLASS_SQL + "SELECT round(sum(tp) / sum(support), 6) AS score FROM f",
    "f1_weighted": CLASS_SQL + "SELECT round(sum(f1 * support) / sum(support), 6) AS score FROM f",
    "precision_weighted": CLASS_SQL + "SELECT round(sum(pr * support) / sum(support), 6) AS score FROM f",
    "recall_weighted": CLASS_SQL + "SELECT round(sum(re * support) / sum(support), 6) AS score FROM f",
    "r2": REG_SQL + "SELECT round(1 - avg(e * e) / var_pop(y), 6) AS score FROM x",
    "neg_mean_squared_error": REG_SQL + "SELECT round(-avg(e * e), 0) AS score FROM x",
    "neg_mean_absolute_error": REG_SQL + "SELECT round(-avg(abs(e)), 4) AS score FROM x",
}
for _scoring, _sql in SCORE_FORMS.items():
    @query(f"scoring_{_scoring}", _sql)
    def _(spark, sf, scoring=_scoring):
        rows = _flags(spark, sf).withColumn("z", F.col("l_quantity") * 1000)
        out = score(rows, scoring, "l_extendedprice", "z") if scoring.startswith(("r2", "neg")) else score(rows, scoring, "t", "p")
        return out.select(r("score", {"neg_mean_squared_error": 0, "neg_mean_absolute_error": 4}.get(scoring, 6)).alias("score"))


@query("scoring_roc_auc", """
WITH x AS (SELECT (l_linestatus = 'O')::INT AS y, l_quantity * l_discount AS s FROM lineitem),
     g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM x GROUP BY s),
     w AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS roc_auc FROM w""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_linestatus") == "O").cast("int").alias("y"), (F.col("l_quantity") * F.col("l_discount")).alias("s"))
    return roc_auc(rows, "y", "s").select(r("roc_auc").alias("roc_auc"))

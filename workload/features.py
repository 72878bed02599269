"""TF-IDF, decompositions, feature scores and selection."""

from __future__ import annotations

import numpy as np

from tablelearn.operators.decompose import NMF, PCA, PCAModel, TruncatedSVD, TruncatedSVDModel
from tablelearn.operators.select import RFE, SelectKBest, SelectPercentile, VarianceThreshold, score_features
from tablelearn.operators.tfidf import TfidfVectorizer
from tablelearn.plans.information import digamma_sql

from .base import F, query, r, spread, table

STOP = ["the", "of", "and", "to", "in", "is", "for", "on", "with", "as", "de", "la", "der", "die", "und", "el"]
TERMS_SQL = """
words AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda t: t NOT IN ({stop})) AS ws FROM documents),
raw AS ({raw}),
tf AS (SELECT doc_id, term, count(*) AS n FROM raw GROUP BY ALL),
vocab AS (SELECT term, sum(n)::BIGINT AS total, count(*) AS df FROM tf GROUP BY term ORDER BY total DESC, term LIMIT {k}),
idf AS (SELECT term, total, (row_number() OVER (ORDER BY term) - 1)::INT AS position,
               ln((1 + (SELECT count(*) FROM documents)) / (1 + df)::DOUBLE) + 1 AS idf FROM vocab),
w AS (SELECT doc_id, term, n * idf AS w FROM tf JOIN idf USING (term)),
norm AS (SELECT doc_id, sqrt(sum(w * w)) AS z FROM w GROUP BY doc_id)"""
UNIGRAMS = "SELECT doc_id, unnest(ws) AS term FROM words"
BIGRAMS = UNIGRAMS + """ UNION ALL
SELECT doc_id, ws[i] || ' ' || ws[i + 1] AS term FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM words)"""
WEIGHTS_SQL = "SELECT doc_id, term, round(w / z, 6) AS weight FROM w JOIN norm USING (doc_id)"


def _terms_sql(raw, k, stop=STOP):
    return "WITH " + TERMS_SQL.format(raw=raw, k=k, stop=", ".join(f"'{s}'" for s in stop) or "''")


def _long(out):
    long = out.select("doc_id", F.explode_outer("tfidf_features").alias("term", "w")).where("term is not null")
    return long.select("doc_id", "term", r("w").alias("weight"))


@query("tfidf_fit_transform", _terms_sql(UNIGRAMS, 100) + WEIGHTS_SQL)
def _(spark, sf):
    out, _model = TfidfVectorizer("text", 100, stop_words=STOP).fit_transform(spread(table(spark, sf, "documents")))
    return _long(out)


@query("tfidf_vocabulary", _terms_sql(BIGRAMS, 200, []) + "SELECT term, position, total, round(idf, 6) AS idf FROM idf")
def _(spark, sf):
    model = TfidfVectorizer("text", 200, ngram=(1, 2), stop_words="none").fit(spread(table(spark, sf, "documents")))
    return model.vocabulary(spark).select("term", "position", "total", r("idf").alias("idf"))


@query("tfidf_transform", _terms_sql(UNIGRAMS, 50) + """,
cw AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS term FROM conversations),
ct AS (SELECT conv_id, turn, term, count(*) AS n FROM cw GROUP BY ALL),
cv AS (SELECT conv_id, turn, term, n * idf AS w FROM ct JOIN idf USING (term)),
cn AS (SELECT conv_id, turn, sqrt(sum(w * w)) AS z FROM cv GROUP BY ALL)
SELECT conv_id, turn, position, round(w / z, 6) AS weight FROM cv JOIN cn USING (conv_id, turn) JOIN idf USING (term)""")
def _(spark, sf):
    model = TfidfVectorizer("text", 50, stop_words=STOP).fit(spread(table(spark, sf, "documents")))
    out = model.transform(spread(table(spark, sf, "conversations")))
    return out.select("conv_id", "turn", F.posexplode("tfidf_vector").alias("position", "w")).where("w != 0").select(
        "conv_id", "turn", "position", r("w").alias("weight"))


def _part(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("a"), F.col("p_retailprice").alias("b"))


PCA_SQL = """
WITH s AS (SELECT avg(p_size) AS ma, avg(p_retailprice) AS mb, var_samp(p_size) AS va, var_samp(p_retailprice) AS vb,
                  covar_samp(p_size, p_retailprice) AS c FROM part),
     e AS (SELECT *, (va + vb) / 2 + sqrt((va - vb) * (va - vb) / 4 + c * c) AS l1, (va + vb) / 2 - sqrt((va - vb) * (va - vb) / 4 + c * c) AS l2 FROM s),
     u AS (SELECT *, c / sqrt(c * c + (l1 - va) * (l1 - va)) AS u1, (l1 - va) / sqrt(c * c + (l1 - va) * (l1 - va)) AS u2 FROM e),
     v AS (SELECT *, CASE WHEN abs(u1) >= abs(u2) THEN sign(u1) ELSE sign(u2) END AS g FROM u),
     p AS (SELECT *, u1 * g AS x1, u2 * g AS x2, CASE WHEN abs(u1) >= abs(u2) THEN -u2 * sign(u1) ELSE u2 * sign(u2) END AS y1,
                  CASE WHEN abs(u1) >= abs(u2) THEN u1 * sign(u1) ELSE -u1 * sign(u2) END AS y2 FROM v)"""


@query("pca_fit", PCA_SQL + """
SELECT 1 AS component, round(l1, 4) AS explained_variance, round(l1 / (l1 + l2), 6) AS ratio, round(l1 / (l1 + l2), 6) AS cumulative,
       round(x1, 6) AS w_a, round(x2, 6) AS w_b, round(ma, 6) AS mean_a FROM p
UNION ALL SELECT 2, round(l2, 4), round(l2 / (l1 + l2), 6), 1.0, round(y1, 6), round(y2, 6), round(ma, 6) FROM p""")
def _(spark, sf):
    m = PCA(["a", "b"], 0).fit(_part(spark, sf))
    rows = [(i + 1, m.explained_variance[i], m.explained_variance_ratio[i], m.cumulative_variance_ratio[i], *m.components[i], m.mean[0]) for i in range(2)]
    out = spark.createDataFrame(rows, "component int, explained_variance double, ratio double, cumulative double, w_a double, w_b double, mean_a double")
    return out.select("component", r("explained_variance", 4).alias("explained_variance"), *[r(c).alias(c) for c in ("ratio", "cumulative", "w_a", "w_b", "mean_a")])


@query("pca_fit_transform", PCA_SQL + """
SELECT p_partkey, round((p_size - ma) * x1 + (p_retailprice - mb) * x2, 5) + 0.0 AS "PC1",
       round((p_size - ma) * y1 + (p_retailprice - mb) * y2, 5) + 0.0 AS "PC2" FROM part, p""")
def _(spark, sf):
    out, _model = PCA(["a", "b"], 2).fit_transform(_part(spark, sf))
    return out.select("p_partkey", r("PC1", 5).alias("PC1"), r("PC2", 5).alias("PC2"))


FIXED = dict(cols=["a", "b"], n_components=2, mean=[25.0, 950.0], components=[[0.6, 0.8], [-0.8, 0.6]])


@query("pca_transform", """
SELECT p_partkey, round((p_size - 25.0) * 0.6 + (p_retailprice - 950.0) * 0.8, 6) + 0.0 AS "PC1",
       round((p_size - 25.0) * -0.8 + (p_retailprice - 950.0) * 0.6, 6) + 0.0 AS "PC2" FROM part""")
def _(spark, sf):
    return PCAModel(**FIXED).transform(_part(spark, sf)).select("p_partkey", r("PC1").alias("PC1"), r("PC2").alias("PC2"))


@query("pca_inverse", "SELECT p_partkey, round(p_size, 6) + 0.0 AS a, round(p_retailprice, 6) + 0.0 AS b FROM part")
def _(spark, sf):
    model = PCAModel(**FIXED)
    out = model.inverse_transform(model.transform(_part(spark, sf)))
    return out.select("p_partkey", r("reconstructed_a").alias("a"), r("reconstructed_b").alias("b"))


@query("pca_embeddings")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    vectors = vectors.select("vec_id", *[F.col("embedding")[i].alias(f"e{i}") for i in range(64)])
    out, m = PCA([f"e{i}" for i in range(64)], 8).fit_transform(vectors)
    return out.select("vec_id", *[r(f"PC{i + 1}").alias(f"PC{i + 1}") for i in range(m.n_components)])


@query("pca_embeddings_variance", """
WITH long AS (SELECT unnest(range(64)) AS j, unnest(embedding::DOUBLE[]) AS e FROM embeddings),
     per AS (SELECT j, var_samp(e) AS v FROM long GROUP BY j)
SELECT round(sum(v), 6) AS total_variance, 64::BIGINT AS orthonormal, true AS ordered FROM per""")
def _(spark, sf):
    """All components together hold the whole variance; they are orthonormal and stand by falling variance."""
    cols = [f"e{i}" for i in range(64)]
    vectors = table(spark, sf, "embeddings").select("vec_id", *[F.col("embedding")[i].alias(c) for i, c in enumerate(cols)])
    m = PCA(cols, 64).fit(vectors)
    axes, held = np.array(m.components), np.array(m.explained_variance)
    unit = int(np.isclose(axes @ axes.T, np.eye(64), atol=1e-9).all(axis=1).sum())
    row = (float(held.sum()), unit, bool((np.diff(held) <= 1e-12).all()))
    return spark.createDataFrame([row], "total_variance double, orthonormal long, ordered boolean").withColumn("total_variance", r("total_variance"))


SVD_SQL = """
WITH s AS (SELECT sum(p_size * p_size)::DOUBLE AS va, sum(p_retailprice * p_retailprice) AS vb, sum(p_size * p_retailprice) AS c FROM part),
     e AS (SELECT *, (va + vb) / 2 + sqrt((va - vb) * (va - vb) / 4 + c * c) AS l1, (va + vb) / 2 - sqrt((va - vb) * (va - vb) / 4 + c * c) AS l2 FROM s),
     p AS (SELECT *, c / sqrt(c * c + (l1 - va) * (l1 - va)) AS x1, (l1 - va) / sqrt(c * c + (l1 - va) * (l1 - va)) AS x2 FROM e)"""


@query("tsvd_fit_transform", SVD_SQL + """
SELECT p_partkey, round(p_size * x1 + p_retailprice * x2, 4) + 0.0 AS svd_component_1, round(sqrt(l1), 4) AS s1 FROM part, p""")
def _(spark, sf):
    out, m = TruncatedSVD(["a", "b"], 1).fit_transform(_part(spark, sf))
    return out.select("p_partkey", r("svd_component_1", 4).alias("svd_component_1"), r(F.lit(m.singular_values[0]), 4).alias("s1"))


@query("tsvd_fit", SVD_SQL + """, z AS (SELECT p_size * x1 + p_retailprice * x2 AS u, p_size * x2 - p_retailprice * x1 AS v, p_size AS a, p_retailprice AS b FROM part, p)
SELECT round(var_pop(u), 4) AS ev1, round(var_pop(v), 4) AS ev2, round(var_pop(u) / (var_pop(a) + var_pop(b)), 6) AS ratio1 FROM z""")
def _(spark, sf):
    m = TruncatedSVD(["a", "b"], 2).fit(_part(spark, sf))
    out = spark.createDataFrame([(*m.explained_variance, m.explained_variance_ratio[0])], "ev1 double, ev2 double, ratio1 double")
    return out.select(r("ev1", 4).alias("ev1"), r("ev2", 4).alias("ev2"), r("ratio1").alias("ratio1"))


@query("tsvd_transform", "SELECT p_partkey, round(p_size * 0.6 + p_retailprice * 0.8, 6) + 0.0 AS svd_component_1 FROM part")
def _(spark, sf):
    model = TruncatedSVDModel(cols=["a", "b"], components=[[0.6, 0.8]])
    return model.transform(_part(spark, sf)).select("p_partkey", r("svd_component_1").alias("svd_component_1"))


LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scaled_lines(spark, sf):
    return spread(table(spark, sf, "lineitem")).select(
        (F.col("l_quantity") / 50).alias("q"), (F.col("l_extendedprice") / 100000).alias("p"), (F.col("l_discount") * 10).alias("d"), (F.col("l_tax") * 10).alias("t"))


@query("nmf_fit_transform")
def _(spark, sf):
    out, m = NMF(["q", "p", "d", "t"], 2, "nndsvda", max_iter=20).fit_transform(_scaled_lines(spark, sf))
    return out.agg(F.count(F.lit(1)).alias("n"), *[r(F.avg(f"nmf_component_{i}"), 4).alias(f"mean_{i}") for i in (1, 2)]).withColumn(
        "reconstruction_error", r(F.lit(m.reconstruction_error), 3)).withColumn("n_iter", F.lit(m.n_iter))


@query("nmf_transform")
def _(spark, sf):
    model = NMF(["q", "p", "d", "t"], 2, "nndsvd", max_iter=5).fit(_scaled_lines(spark, sf))
    parts = table(spark, sf, "part").select("p_partkey", (F.col("p_size") / 50).alias("q"), (F.col("p_retailprice") / 1000).alias("p"), F.lit(0.5).alias("d"), F.lit(0.4).alias("t"))
    return model.transform(parts).select("p_partkey", r("nmf_component_1").alias("nmf_component_1"), r("nmf_component_2").alias("nmf_component_2"))


F_CLASSIF = """
(WITH g AS (SELECT l_returnflag, count(*) AS n, avg({c}) AS m, var_pop({c}) AS v FROM lineitem GROUP BY 1),
      t AS (SELECT sum(n) AS nn, count(*) AS k, sum(n * m) / sum(n) AS mm FROM g)
 SELECT '{c}' AS feature, round((sum(n * (m - mm) * (m - mm)) / (any_value(k) - 1)) / (sum(n * v) / (any_value(nn) - any_value(k))), 6) AS score FROM g, t)"""
F_REGRESSION = """
(SELECT '{c}' AS feature, round(corr({c}, l_quantity) ** 2 / (1 - corr({c}, l_quantity) ** 2) * (count(*) - 2), 6) AS score FROM lineitem)"""
CHI2 = """
(WITH g AS (SELECT l_returnflag, count(*) AS n, sum({c}) AS o FROM lineitem GROUP BY 1),
      t AS (SELECT sum(n) AS nn, sum(o) AS s FROM g)
 SELECT '{c}' AS feature, round(sum((o - n / nn * s) * (o - n / nn * s) / (n / nn * s)), 6) AS score FROM g, t)"""


def _mi(label):
    return """
(WITH x AS (SELECT {c}::DOUBLE AS v, """ + label + """ AS y0 FROM lineitem), e AS (SELECT min(v) AS a, max(v) AS b FROM x),
      g AS (SELECT least(floor((v - a) / (b - a) * 10.0), 9) AS b, y0 AS y, count(*) AS n FROM x, e GROUP BY ALL),
      t AS (SELECT sum(n) AS nn FROM g)
 SELECT '{c}' AS feature, round(sum(n / nn * ln(n * nn / (nb * ny))), 6) + 0.0 AS score
 FROM (SELECT *, sum(n) OVER (PARTITION BY b) AS nb, sum(n) OVER (PARTITION BY y) AS ny FROM g), t)"""


def _all(body, cols):
    return " UNION ALL ".join(body.format(c=c) for c in cols)


# Counts of values below a bound by ASOF joins with running counts; the k-th other row of a class by windows.
NEAR_CLASS = f"""
WITH cells AS (SELECT unnest({LINE}) AS j, unnest([{", ".join(f"{c}::DOUBLE" for c in LINE)}]) AS x, l_returnflag AS c FROM lineitem),
v AS (SELECT * FROM (SELECT j, c, x, count(*) AS w, sum(count(*)) OVER (PARTITION BY j, c) AS n FROM cells GROUP BY j, c, x) WHERE n > 1),
near AS (SELECT *, unnest([{", ".join(f"{{'d': abs({f}(x, {i}) OVER o - x), 'w': {f}(w, {i}) OVER o}}" for i in (1, 2, 3) for f in ("lag", "lead"))}]) AS e
         FROM v WINDOW o AS (PARTITION BY j, c ORDER BY x)),
met AS (SELECT j, c, x, w, n, e.d AS d, e.w AS ew, w + sum(e.w) OVER (PARTITION BY j, c, x ORDER BY e.d ROWS UNBOUNDED PRECEDING) AS met FROM near WHERE e.d IS NOT NULL),
reach AS (SELECT j, c, x, w, n, CASE WHEN w > least(3, n - 1) THEN 0.0 ELSE min(d) FILTER (met > least(3, n - 1)) END AS r FROM met GROUP BY j, c, x, w, n),
inside AS (SELECT r.j, r.c, r.x, r.w, r.n, r.r, r.w + coalesce(sum(ew) FILTER (d < r.r), 0) AS k FROM reach r JOIN met USING (j, c, x) GROUP BY r.j, r.c, r.x, r.w, r.n, r.r),
col AS (SELECT j, x, sum(w) AS w, sum(sum(w)) OVER (PARTITION BY j ORDER BY x) AS upto FROM v GROUP BY j, x),
high AS (SELECT i.*, i.x - i.r AS lo, coalesce(col.upto, 0) AS below FROM inside i ASOF LEFT JOIN col ON col.j = i.j AND i.x + i.r > col.x),
low AS (SELECT h.*, coalesce(col.upto, 0) AS upto FROM high h ASOF LEFT JOIN col ON col.j = h.j AND h.lo >= col.x),
m AS (SELECT low.*, CASE WHEN r > 0 THEN below - low.upto ELSE col.w END AS m FROM low JOIN col ON col.j = low.j AND col.x = low.x)
SELECT j AS feature, round(greatest(0, {digamma_sql("sum(w)::DOUBLE")} + sum(w * ({digamma_sql("k::DOUBLE")} - {digamma_sql("n::DOUBLE")} - {digamma_sql("m::DOUBLE")})) / sum(w)), 6) + 0.0 AS score
FROM m GROUP BY j"""
PRICE_COLS = ["l_extendedprice", "l_discount", "l_tax"]
QBIN = "least(floor((l_quantity - (SELECT min(l_quantity) FROM lineitem)) / (SELECT max(l_quantity) - min(l_quantity) FROM lineitem) * 10.0), 9)"
SCORE_SQL = {
    "f_classif": (_all(F_CLASSIF, LINE), LINE, "l_returnflag"),
    "f_regression": (_all(F_REGRESSION, PRICE_COLS), PRICE_COLS, "l_quantity"),
    "chi2": (_all(CHI2, LINE), LINE, "l_returnflag"),
    "mutual_info_classif_binned": (_all(_mi("l_returnflag"), LINE), LINE, "l_returnflag"),
    "mutual_info_regression_binned": (_all(_mi(QBIN), PRICE_COLS), PRICE_COLS, "l_quantity"),
    "mutual_info_classif": (NEAR_CLASS, LINE, "l_returnflag"),
}
for _name, (_sql, _cols, _target) in SCORE_SQL.items():
    @query(f"score_{_name}", _sql)
    def _(spark, sf, name=_name, cols=_cols, target=_target):
        values = score_features(table(spark, sf, "lineitem"), cols, target, name)
        return spark.createDataFrame(list(zip(cols, values)), "feature string, score double").select("feature", r("score").alias("score"))


# Customers by balance and nation; the three nearest by the larger gap, all pairs.
NEAR_NUMBER = f"""
WITH s AS (SELECT stddev_pop(c_acctbal) AS da, stddev_pop(c_nationkey) AS dn FROM customer),
x AS (SELECT row_number() OVER () AS id, c_acctbal / da AS x, c_nationkey / dn AS y FROM customer, s),
g AS (SELECT a.id, greatest(abs(a.x - b.x), abs(a.y - b.y)) AS d, abs(a.x - b.x) AS dx, abs(a.y - b.y) AS dy, a.x, a.y, b.x AS bx, b.y AS by_, a.id <> b.id AS other FROM x a, x b),
r AS (SELECT id, max(d) AS r FROM (SELECT id, d FROM g WHERE other QUALIFY row_number() OVER (PARTITION BY id ORDER BY d) <= 3) GROUP BY id),
n AS (SELECT id, sum((CASE WHEN r > 0 THEN d < r ELSE d = 0 END)::INT) AS k, sum((CASE WHEN r > 0 THEN bx > x - r AND bx < x + r ELSE bx = x END)::INT) AS m,
             sum((CASE WHEN r > 0 THEN by_ > y - r AND by_ < y + r ELSE by_ = y END)::INT) AS l FROM g JOIN r USING (id) GROUP BY id)
SELECT 'c_nationkey' AS feature, round(greatest(0, {digamma_sql("count(*)::DOUBLE")} + avg({digamma_sql("k::DOUBLE")} - {digamma_sql("m::DOUBLE")} - {digamma_sql("l::DOUBLE")})), 6) + 0.0 AS score FROM n"""


@query("score_mutual_info_regression", NEAR_NUMBER)
def _(spark, sf):
    values = score_features(table(spark, sf, "customer"), ["c_nationkey"], "c_acctbal", "mutual_info_regression")
    return spark.createDataFrame([("c_nationkey", *values)], "feature string, score double").select("feature", r("score").alias("score"))


@query("select_k_best", f"""
WITH s AS ({_all(F_CLASSIF, LINE)})
SELECT feature, score, row_number() OVER (ORDER BY score DESC) <= 2 AS selected FROM s""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    model = SelectKBest(LINE, "l_returnflag", 2).fit(lines)
    model.transform(lines)  # adds selected_<col>
    return model.report(spark).select("feature", r("score").alias("score"), "selected")


@query("select_k_best_rows", f"""
WITH s AS ({_all(F_CLASSIF, LINE)}), k AS (SELECT feature FROM s ORDER BY score DESC LIMIT 1)
SELECT l_linestatus, round(sum(CASE feature WHEN 'l_quantity' THEN l_quantity WHEN 'l_extendedprice' THEN l_extendedprice
       WHEN 'l_discount' THEN l_discount ELSE l_tax END), 2) AS total FROM lineitem, k GROUP BY 1""")
def _(spark, sf):
    out, model = SelectKBest(LINE, "l_returnflag", 1).fit_transform(table(spark, sf, "lineitem"))
    return out.groupBy("l_linestatus").agg(r(F.sum(f"selected_{model.selected()[0]}"), 2).alias("total"))


@query("select_percentile", f"""
WITH s AS ({_all(F_CLASSIF, LINE)}), c AS (SELECT quantile_cont(score, 0.5) AS cut FROM s)
SELECT feature, score, score > cut AS selected FROM s, c""")
def _(spark, sf):
    model = SelectPercentile(LINE, "l_returnflag", 50).fit(table(spark, sf, "lineitem"))
    return model.report(spark).select("feature", r("score").alias("score"), "selected")


@query("variance_threshold", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(var_pop({c}), 4) AS score, var_pop({c}) > 0.001 AS selected FROM lineitem" for c in LINE))
def _(spark, sf):
    model = VarianceThreshold(LINE, 0.001).fit(table(spark, sf, "lineitem"))
    return model.report(spark).select("feature", r("score", 4).alias("score"), "selected")


@query("rfe")
def _(spark, sf):
    model = RFE(LINE, "l_linenumber", 2, "LinearRegression").fit(table(spark, sf, "lineitem"))
    return model.report(spark).withColumnRenamed("score", "ranking")


@query("rfe_logistic")
def _(spark, sf):
    model = RFE(["q", "p", "d", "t"], "f", 2, "LogisticRegression").fit(_scaled_lines(spark, sf).withColumn("f", (F.col("q") * 50 > 25).cast("int")))
    return model.report(spark).withColumnRenamed("score", "ranking")

"""Sources, scalers, encoders, imputer, polynomial terms."""

from __future__ import annotations

from tablelearn.core import state_from_table, state_table
from tablelearn.operators.encoders import LabelEncoder, OneHotEncoder
from tablelearn.operators.imputer import SimpleImputer
from tablelearn.operators.polynomial import PolynomialFeatures
from tablelearn.operators.scalers import MinMaxScaler, RobustScaler, StandardScaler, binarizer, normalizer
from tablelearn.sources.generate import make_classification, make_regression, pack_arrays

from .base import F, query, r, table

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _byte(i, text):
    """SQL: the i-th byte of an md5 digest."""
    a, b = f"substr({text}, {1 + 2 * i}, 1)", f"substr({text}, {2 + 2 * i}, 1)"
    return f"((instr('0123456789abcdef', {a}) - 1) * 16 + instr('0123456789abcdef', {b}) - 1)"


def _normal(digest):
    return "(" + " + ".join(f"({_byte(i, digest)} + 0.5) / 256.0::DOUBLE" for i in range(12)) + " - 6)"


WEIGHTS = [10.0, -20.0, 30.0]


@query("make_regression", f"""
WITH d AS (SELECT o_orderkey AS id, {', '.join(f"md5(o_orderkey || '-x{i}-42') AS m{i}" for i in range(3))},
                  md5(o_orderkey || '-noise-42') AS mn FROM orders),
     x AS (SELECT id, {', '.join(f"{_normal(f'm{i}')} AS f{i}" for i in range(3))}, {_normal('mn')} AS e FROM d)
SELECT id, round(f0, 6) + 0.0 AS feature_0, round(f1, 6) + 0.0 AS feature_1, round(f2, 6) + 0.0 AS feature_2,
       round(f0 * 10.0 + f1 * -20.0 + f2 * 30.0 + 10.0 * e, 4) + 0.0 AS target FROM x""")
def _(spark, sf):
    ids = table(spark, sf, "orders").select("o_orderkey")
    rows = make_regression(spark, n_features=3, ids=ids, id_col="o_orderkey", weights=WEIGHTS)
    return rows.select("id", *[r(f"feature_{i}").alias(f"feature_{i}") for i in range(3)], r("target", 4).alias("target"))


@query("make_classification", f"""
WITH d AS (SELECT c_custkey AS id, {', '.join(f"md5(c_custkey || '-x{i}-42') AS m{i}" for i in range(2))},
                  CASE WHEN substr(md5(c_custkey || '-class-42'), 1, 1) >= '8' THEN 1 ELSE 0 END AS target FROM customer)
SELECT id, target, round({_normal('m0')} + CASE WHEN target = 1 THEN 1.0 ELSE -1.0 END, 6) + 0.0 AS feature_0,
       round({_normal('m1')} - CASE WHEN target = 1 THEN 1.0 ELSE -1.0 END, 6) + 0.0 AS feature_1 FROM d""")
def _(spark, sf):
    rows = make_classification(spark, n_features=2, ids=table(spark, sf, "customer").select("c_custkey"), id_col="c_custkey")
    return rows.select("id", "target", r("feature_0").alias("feature_0"), r("feature_1").alias("feature_1"))


@query("rows_vs_arrays", """
SELECT o_orderstatus AS "group", floor(o_orderkey / 1000.0)::BIGINT AS chunk, count(*) OVER w AS n_samples,
       (row_number() OVER (PARTITION BY o_orderstatus, floor(o_orderkey / 1000.0) ORDER BY o_orderkey) - 1)::INT AS pos,
       o_orderkey AS id, o_totalprice AS value
FROM orders WINDOW w AS (PARTITION BY o_orderstatus, floor(o_orderkey / 1000.0))""")
def _(spark, sf):
    packed = pack_arrays(table(spark, sf, "orders"), "o_orderkey", ["o_totalprice"], group="o_orderstatus")
    long = packed.select("group", "chunk", "n_samples", F.posexplode(F.arrays_zip("ids", "features")).alias("pos", "e"))
    return long.select("group", "chunk", "n_samples", "pos", F.col("e.ids").alias("id"), F.col("e.features")[0].alias("value"))


@query("model_state", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders)
SELECT o_orderkey, round((o_totalprice - m) / d, 6) + 0.0 AS scaled FROM orders, s""")
def _(spark, sf):
    orders = table(spark, sf, "orders")
    stored = state_table(spark, StandardScaler("o_totalprice").fit(orders))
    return state_from_table(stored).transform(orders).select("o_orderkey", r("scaled_o_totalprice").alias("scaled"))


def _union(cols, body):
    return " UNION ALL ".join(body.format(c=c) for c in cols)


@query("standard_scaler_fit", _union(LINE, """
SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS scale, round(var_pop({c}), 2) AS variance,
       count(*) AS fitted_samples FROM lineitem"""))
def _(spark, sf):
    m = StandardScaler(LINE).fit(table(spark, sf, "lineitem"))
    out = m.table(spark, "mean", "scale", "variance")
    return out.select("feature", r("mean", 4).alias("mean"), r("scale", 4).alias("scale"), r("variance", 2).alias("variance"),
                      F.lit(m.fitted_samples).cast("long").alias("fitted_samples"))


@query("standard_scaler_fit_transform", """
WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d, avg(user_id) AS mu, stddev_pop(user_id) AS du FROM events)
SELECT event_id, round((value - m) / d, 6) + 0.0 AS scaled_value, round((user_id - mu) / du, 6) + 0.0 AS scaled_user_id FROM events, s""")
def _(spark, sf):
    out, _model = StandardScaler(["value", "user_id"]).fit_transform(table(spark, sf, "events"))
    return out.select("event_id", r("scaled_value").alias("scaled_value"), r("scaled_user_id").alias("scaled_user_id"))


@query("standard_scaler_transform", """
WITH s AS (SELECT stddev_pop(c_acctbal) AS d FROM customer)
SELECT s_suppkey, round(s_acctbal / d, 6) + 0.0 AS scaled FROM supplier, s""")
def _(spark, sf):
    model = StandardScaler("balance", with_mean=False).fit(table(spark, sf, "customer").select(F.col("c_acctbal").alias("balance")))
    out = model.transform(table(spark, sf, "supplier").withColumnRenamed("s_acctbal", "balance"))
    return out.select("s_suppkey", r("scaled_balance").alias("scaled"))


@query("minmax_scaler_fit", _union(LINE, """
SELECT '{c}' AS feature, round(min({c}), 6) + 0.0 AS data_min, round(max({c}), 6) AS data_max, round(max({c}) - min({c}), 6) AS data_range,
       round(2.0 / (max({c}) - min({c})), 9) AS scale, round(-1 - min({c}) * (2.0 / (max({c}) - min({c}))), 6) + 0.0 AS min FROM lineitem"""))
def _(spark, sf):
    out = MinMaxScaler(LINE, (-1, 1)).fit(table(spark, sf, "lineitem")).table(spark, "data_min", "data_max", "data_range", "scale", "min")
    return out.select("feature", *[r(c).alias(c) for c in ("data_min", "data_max", "data_range")], r("scale", 9).alias("scale"), r("min").alias("min"))


@query("minmax_scaler_fit_transform", """
WITH s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders)
SELECT o_orderkey, round((o_totalprice - a) / (b - a), 6) + 0.0 AS scaled FROM orders, s""")
def _(spark, sf):
    out, _model = MinMaxScaler("o_totalprice").fit_transform(table(spark, sf, "orders"))
    return out.select("o_orderkey", r("scaled_o_totalprice").alias("scaled"))


def _balances(spark, sf):
    return (table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("b")),
            table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("b")))


@query("minmax_scaler_transform", """
WITH s AS (SELECT min(c_acctbal) AS a, max(c_acctbal) AS b FROM customer)
SELECT s_suppkey AS k, round((s_acctbal - a) / (b - a) * 10, 6) + 0.0 AS scaled FROM supplier, s""")
def _(spark, sf):
    train, new = _balances(spark, sf)
    return MinMaxScaler("b", (0, 10)).fit(train).transform(new).select("k", r("scaled_b").alias("scaled"))


@query("minmax_scaler_inverse", "SELECT s_suppkey AS k, round(s_acctbal, 6) + 0.0 AS original FROM supplier")
def _(spark, sf):
    train, new = _balances(spark, sf)
    model = MinMaxScaler("b", (0, 10)).fit(train)
    return model.inverse_transform(model.transform(new)).select("k", r("original_b").alias("original"))


@query("robust_scaler_fit_transform", """
WITH s AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS w FROM events)
SELECT event_id, round((value - m) / w, 6) + 0.0 AS value_scaled, round(m, 6) AS center, round(w, 6) AS scale FROM events, s""")
def _(spark, sf):
    out, m = RobustScaler("value").fit_transform(table(spark, sf, "events"))
    return out.select("event_id", r("value_scaled").alias("value_scaled"), r(F.lit(m.center[0])).alias("center"), r(F.lit(m.scale[0])).alias("scale"))


@query("robust_scaler_transform", """
WITH s AS (SELECT quantile_cont(c_acctbal, 0.5) AS m, quantile_cont(c_acctbal, 0.9) - quantile_cont(c_acctbal, 0.1) AS w FROM customer)
SELECT s_suppkey AS k, round((s_acctbal - m) / w, 6) + 0.0 AS scaled FROM supplier, s""")
def _(spark, sf):
    train, new = _balances(spark, sf)
    return RobustScaler("b", quantiles="10-90").fit(train).transform(new).select("k", r("b_scaled").alias("scaled"))


@query("robust_scaler_inverse", "SELECT s_suppkey AS k, round(s_acctbal, 6) + 0.0 AS original FROM supplier")
def _(spark, sf):
    train, new = _balances(spark, sf)
    model = RobustScaler("b", quantiles="5-95").fit(train)
    return model.inverse_transform(model.transform(new)).select("k", r("b_original").alias("original"))


NORMS = {"l2": "sqrt(p_size * p_size + p_retailprice * p_retailprice)", "l1": "abs(p_size) + abs(p_retailprice)",
         "max": "greatest(abs(p_size), abs(p_retailprice))"}
for _norm, _size in NORMS.items():
    @query("normalizer" if _norm == "l2" else f"normalizer_{_norm}", f"""
    SELECT p_partkey, round(p_size / ({_size}), 6) + 0.0 AS a, round(p_retailprice / ({_size}), 6) + 0.0 AS b FROM part""")
    def _(spark, sf, norm=_norm):
        out = normalizer(table(spark, sf, "part"), ["p_size", "p_retailprice"], norm)
        return out.select("p_partkey", r("p_size_normalized").alias("a"), r("p_retailprice_normalized").alias("b"))


@query("binarizer", "SELECT event_id, CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END::DOUBLE AS value_binary FROM events")
def _(spark, sf):
    return binarizer(table(spark, sf, "events"), "value", 50).select("event_id", "value_binary")


@query("label_encoder_fit_transform", """
SELECT o_orderkey, o_orderpriority, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INT AS o_orderpriority_encoded FROM orders""")
def _(spark, sf):
    out, _model = LabelEncoder("o_orderpriority").fit_transform(table(spark, sf, "orders"))
    return out.select("o_orderkey", "o_orderpriority", "o_orderpriority_encoded")


@query("label_encoder_transform", """
WITH m AS (SELECT c_custkey::VARCHAR AS v, row_number() OVER (ORDER BY c_custkey::VARCHAR) - 1 AS code FROM customer)
SELECT o_orderkey, code::INT AS code FROM orders JOIN m ON v = o_custkey::VARCHAR""")
def _(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"))
    orders = table(spark, sf, "orders").withColumnRenamed("o_custkey", "key")
    return LabelEncoder("key", "code").fit(customers).transform(orders).select("o_orderkey", "code")


@query("label_encoder_mapping", """
SELECT v AS label, (row_number() OVER (ORDER BY v) - 1)::INT AS code FROM (SELECT DISTINCT p_name AS v FROM part)""")
def _(spark, sf):
    model = LabelEncoder("p_name", broadcast_classes=100).fit(table(spark, sf, "part"))
    return model.mapping(spark)


@query("label_encoder_inverse", """
SELECT n_nationkey, n_name AS decoded, (row_number() OVER (ORDER BY n_name) - 1)::INT AS encoded FROM nation""")
def _(spark, sf):
    out, model = LabelEncoder("n_name", "encoded").fit_transform(table(spark, sf, "nation"))
    return model.inverse_transform(out.drop("n_name"), "encoded", "decoded").select("n_nationkey", "decoded", "encoded")


PRIORITY = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("one_hot_fit_transform", "SELECT o_orderkey, " + ", ".join(
    f"""CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS "{c}_{v}" """
    for c, vs in (("o_orderstatus", ["F", "O", "P"]), ("o_orderpriority", PRIORITY)) for v in vs) + " FROM orders")
def _(spark, sf):
    out, model = OneHotEncoder(["o_orderstatus", "o_orderpriority"]).fit_transform(table(spark, sf, "orders"))
    return out.select("o_orderkey", *[F.col(f"`{c}`") for c in model.output_columns()])


@query("one_hot_transform", "SELECT p_partkey, " + ", ".join(
    f"""CASE WHEN p_type = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS "p_type_{v}" """
    for v in ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]) + " FROM part")
def _(spark, sf):
    part = table(spark, sf, "part")
    model = OneHotEncoder("p_type", drop_first=True, handle_unknown="ignore").fit(part)
    return model.transform(part).select("p_partkey", *[F.col(f"`{c}`") for c in model.output_columns()])


GAPS = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END"


def _gaps(spark, sf):
    gap = F.col("event_id") % 7 == 0
    return table(spark, sf, "events").select("event_id", F.when(~gap, F.col("value")).alias("value"), F.when(gap, "").otherwise(F.col("event_type")).alias("event_type"))


for _strategy, _fill in {"mean": f"avg({GAPS})", "median": f"quantile_cont({GAPS}, 0.5)"}.items():
    @query("imputer_fit_transform" if _strategy == "mean" else f"imputer_{_strategy}", f"""
    WITH s AS (SELECT {_fill} AS fill FROM events) SELECT event_id, round(coalesce({GAPS}, fill), 6) + 0.0 AS value FROM events, s""")
    def _(spark, sf, strategy=_strategy):
        out, _model = SimpleImputer("value", strategy).fit_transform(_gaps(spark, sf))
        return out.select("event_id", r("value").alias("value"))


@query("imputer_most_frequent", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type END AS t FROM events),
     s AS (SELECT t AS fill FROM e WHERE t IS NOT NULL GROUP BY t ORDER BY count(*) DESC, t LIMIT 1)
SELECT event_id, coalesce(t, fill) AS event_type FROM e, s""")
def _(spark, sf):
    out, _model = SimpleImputer("event_type", "most_frequent").fit_transform(_gaps(spark, sf))
    return out.select("event_id", "event_type")


@query("imputer_constant", f"SELECT event_id, coalesce({GAPS}, -1.5) AS value FROM events")
def _(spark, sf):
    out, _model = SimpleImputer("value", "constant", "-1.5").fit_transform(_gaps(spark, sf))
    return out.select("event_id", "value")


@query("imputer_transform", f"""
WITH s AS (SELECT avg(o_totalprice) AS fill FROM orders) SELECT event_id, round(coalesce({GAPS}, fill), 6) + 0.0 AS value FROM events, s""")
def _(spark, sf):
    model = SimpleImputer("value").fit(table(spark, sf, "orders").select(F.col("o_totalprice").alias("value")))
    return model.transform(_gaps(spark, sf)).select("event_id", r("value").alias("value"))


@query("polynomial_fit_transform", """
SELECT p_partkey, 1.0::DOUBLE AS "1", p_size::DOUBLE AS s, p_retailprice AS p, (p_size * p_size)::DOUBLE AS "s^2",
       round(p_size * p_retailprice, 4) AS "s p", round(p_retailprice * p_retailprice, 4) AS "p^2" FROM part""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("s"), F.col("p_retailprice").alias("p"))
    out, model = PolynomialFeatures(["s", "p"], 2).fit_transform(part)
    return out.select("p_partkey", *[r(F.col(f"`{c}`"), 4).alias(c) for c in model.feature_names()])


@query("polynomial_transform", """
SELECT l_quantity::INT AS qty, count(*) AS n, round(sum(l_quantity * l_discount), 4) AS qd, round(sum(l_quantity * l_tax), 4) AS qt,
       round(sum(l_discount * l_tax), 4) AS dt, round(sum(l_quantity * l_discount * l_tax), 4) AS qdt FROM lineitem GROUP BY 1""")
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_tax").alias("t"))
    model = PolynomialFeatures(["q", "d", "t"], 3, include_bias=False, interaction_only=True).fit(lines)
    sums = [r(F.sum(F.col(f"`{a}`")), 4).alias(b) for a, b in (("q d", "qd"), ("q t", "qt"), ("d t", "dt"), ("q d t", "qdt"))]
    return model.transform(lines).groupBy(F.col("q").cast("int").alias("qty")).agg(F.count(F.lit(1)).alias("n"), *sums)

"""Classification, regression and clustering metrics, and the scorers that model selection uses."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import as_double, feature_array, names, require, sorted_classes
from ..plans.neighbors import mean_silhouette
from ..plans.ranking import running_total

EPSILON = float(np.finfo(np.float64).eps)
SCORERS = (
    "accuracy", "f1_weighted", "precision_weighted", "recall_weighted", "roc_auc", "r2",
    "neg_mean_squared_error", "neg_mean_absolute_error",
)


def _counts(df, true, pred, by=()):
    require(df, [true, pred])
    return df.groupBy(*by, F.col(f"`{true}`").alias("t"), F.col(f"`{pred}`").alias("p")).agg(F.count(F.lit(1)).alias("n"))


def _per_class(counts, by=()):
    """tp, support and predicted count of every class seen on either side; input is the small pair-count table."""
    sides = F.array(
        F.struct(F.col("t").alias("c"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )
    agg = (
        counts.select(*by, F.explode(sides).alias("s")).groupBy(*by, "s.c")
        .agg(*[F.sum(f"s.{f}").alias(f) for f in ("support", "predicted", "tp")])
    )
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    agg = agg.withColumn("precision", ratio(F.col("tp"), F.col("predicted"))).withColumn("recall", ratio(F.col("tp"), F.col("support")))
    pr = F.col("precision") + F.col("recall")
    return agg.withColumn("f1", F.when(pr == 0, 0.0).otherwise(2 * F.col("precision") * F.col("recall") / pr))


def classification_report(df: DataFrame, true: str, pred: str) -> DataFrame:
    """One row per class: support, predicted, tp, precision, recall, f1."""
    return _per_class(_counts(df, true, pred)).withColumnRenamed("c", "class")


def classification_metrics(df: DataFrame, true: str, pred: str, average="weighted", by=()) -> DataFrame:
    """accuracy, precision, recall, f1, support, classes in one row (one row per group with ``by``).

    ``binary`` scores class 1; when the classes are not binary it becomes ``weighted``, as ``average_used`` tells.
    """
    if average not in ("binary", "micro", "macro", "weighted"):
        raise ValueError("average must be binary, micro, macro or weighted")
    by = list(by)
    per = _per_class(_counts(df, true, pred, by), by)
    support = F.sum("support")
    accuracy = F.sum("tp") / support
    one = F.col("c").cast("string").isin("1", "1.0")
    mean = {
        "micro": lambda m: accuracy,
        "macro": lambda m: F.avg(m),
        "weighted": lambda m: F.sum(F.col(m) * F.col("support")) / support,
    }
    is_binary = (F.count(F.lit(1)) <= 2) & ((F.max(F.when(one, 1).otherwise(0)) == 1) | (F.count(F.lit(1)) == 1))
    numeric = per.schema["c"].dataType.simpleString() != "string"

    def value(m):
        if average != "binary":
            return mean[average](m)
        if not numeric:
            return mean["weighted"](m)
        return F.when(is_binary, F.coalesce(F.max(F.when(one, F.col(m))), F.lit(0.0))).otherwise(mean["weighted"](m))

    used = F.lit(average)
    if average == "binary":
        used = F.when(is_binary, F.lit("binary")).otherwise(F.lit("weighted")) if numeric else F.lit("weighted")
    aggs = [
        accuracy.alias("accuracy"), value("precision").alias("precision"), value("recall").alias("recall"),
        value("f1").alias("f1"), support.alias("support"), F.count(F.lit(1)).alias("n_classes"), used.alias("average_used"),
    ]
    return per.groupBy(*by).agg(*aggs) if by else per.agg(*aggs)


def confusion_matrix(df: DataFrame, true: str, pred: str) -> DataFrame:
    """One row per true class (sorted): counts over the sorted predicted classes as an array."""
    classes = sorted(set(sorted_classes(df, true)) | set(sorted_classes(df, pred)))
    cells = _counts(df, true, pred).groupBy("t").agg(F.map_from_entries(F.collect_list(F.struct("p", "n"))).alias("m"))
    row = F.array(*[F.coalesce(F.col("m")[F.lit(c)], F.lit(0)).cast("long") for c in classes])
    every = df.sparkSession.createDataFrame([(c,) for c in classes], f"t {cells.schema['t'].dataType.simpleString()}")
    return every.join(cells, "t", "left").select(F.col("t").alias("true_class"), row.alias("counts"))


def regression_metrics(df: DataFrame, true: str, pred: str, by=()) -> DataFrame:
    """mse, rmse, mae, r2, mape, explained variance, support from one aggregate."""
    require(df, [true, pred])
    by = list(by)
    data = df.select(*by, as_double(df, true).alias("y"), as_double(df, pred).alias("z")).withColumn("e", F.col("y") - F.col("z"))
    mse, spread, noise = F.avg(F.col("e") * F.col("e")), F.var_pop("y"), F.var_pop("e")
    r2 = lambda a: F.when(spread > 0, 1 - a / spread).otherwise(F.when(a == 0, 1.0).otherwise(0.0))
    aggs = [
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs("e")).alias("mae"), r2(mse).alias("r2"),
        F.avg(F.abs("e") / F.greatest(F.abs("y"), F.lit(EPSILON))).alias("mape"),
        r2(noise).alias("explained_variance"), F.count(F.lit(1)).alias("support"),
    ]
    return data.groupBy(*by).agg(*aggs) if by else data.agg(*aggs)


def roc_auc(df: DataFrame, true: str, score: str, positive=1) -> DataFrame:
    """Area under the ROC curve by the rank-sum identity; equal scores count half.

    Rows are first reduced to counts per distinct score, then a range-partitioned running total gives the
    negatives below each score.
    """
    require(df, [true, score])
    hit = F.when(F.col(f"`{true}`") == F.lit(positive), 1).otherwise(0)
    by_score = df.groupBy(as_double(df, score).alias("s")).agg(
        F.sum(hit).cast("long").alias("pos"), F.sum(1 - hit).cast("long").alias("neg")
    )
    ranked = running_total(by_score, ["s"], "neg", "below")
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.when(pairs > 0, wins / pairs).alias("roc_auc"))


def score(df: DataFrame, scoring: str, true: str, pred: str = "prediction", by=()) -> DataFrame:
    """One scorer as column ``score`` (higher is better). roc_auc reads ``pred`` as the positive-class score."""
    if scoring in ("r2", "neg_mean_squared_error", "neg_mean_absolute_error"):
        m = regression_metrics(df, true, pred, by)
        value = {"r2": F.col("r2"), "neg_mean_squared_error": -F.col("mse"), "neg_mean_absolute_error": -F.col("mae")}[scoring]
    elif scoring == "roc_auc":
        if by:
            raise ValueError("roc_auc is scored one group at a time")
        m = roc_auc(df, true, pred)
        value = F.col("roc_auc")
    elif scoring in SCORERS:
        m = classification_metrics(df, true, pred, "weighted", by)
        value = F.col(scoring.split("_")[0])
    else:
        raise ValueError(f"unknown scoring {scoring}; use one of {SCORERS}")
    return m.select(*by, value.alias("score"))


MAX_CLUSTERS = 5_000


def clustering_metrics(df: DataFrame, cols, cluster: str, id_col: str | None = None, silhouette="euclidean") -> DataFrame:
    """Calinski-Harabasz, Davies-Bouldin and silhouette; one row, with ``error`` set when 1 < k < n fails.

    ``silhouette='euclidean'`` sums the distances of all pairs of distinct rows (needs ``id_col``): in bounded block pairs, which
    is quadratic; many rows of one or two columns through a tree, up to a relative error of about 1e-12 (``plans/farfield.py``). ``'squared'`` uses squared distances, which per-cluster sums give in one
    linear pass, under the name ``silhouette_squared``. ``None`` leaves it out.
    """
    cols = names(cols)
    require(df, cols + [cluster])
    spark = df.sparkSession
    data = df.select(feature_array(df, cols).alias("x"), F.col(f"`{cluster}`").alias("c"))
    per = (
        data.select("c", F.posexplode("x").alias("j", "v")).groupBy("c", "j")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
        .groupBy("c").agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("j", "m", "s"))).alias("js"))
    )
    found = per.limit(MAX_CLUSTERS + 1).collect()
    if len(found) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    found.sort(key=lambda r: r.c)
    sizes = np.array([r.n for r in found], dtype=float)
    n, k = int(sizes.sum()), len(found)
    if not 1 < k < n:
        return spark.createDataFrame([(k, n, f"need 1 < clusters < rows, got {k} clusters for {n} rows")], "n_clusters int, support long, error string")
    centres = np.array([[j.m for j in r.js] for r in found])
    within = sum(r.n * sum(j.s for j in r.js) for r in found)
    overall = (sizes[:, None] * centres).sum(axis=0) / n
    between = (sizes * ((centres - overall) ** 2).sum(axis=1)).sum()
    table = spark.createDataFrame([(r.c, m.tolist()) for r, m in zip(found, centres)], f"c {data.schema['c'].dataType.simpleString()}, m array<double>")
    gap = F.sqrt(F.aggregate(F.zip_with("x", "m", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v))
    mean_gap = {r.c: r.g for r in data.join(F.broadcast(table), "c").groupBy("c").agg(F.avg(gap).alias("g")).collect()}
    spread = np.array([mean_gap[r.c] for r in found])
    far = np.sqrt(((centres[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)) if k <= 1000 else None
    worst = []
    for i in range(k):
        d = far[i] if far is not None else np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
        ratio = np.divide(spread + spread[i], d, out=np.zeros(k), where=d > 0)
        ratio[i] = 0.0
        worst.append(ratio.max())
    values = {
        "calinski_harabasz": 1.0 if within == 0 else float(between * (n - k) / (within * (k - 1))),
        "davies_bouldin": float(np.mean(worst)), "n_clusters": k, "support": n,
    }
    if silhouette == "euclidean":
        if id_col is None:
            raise ValueError("the Euclidean silhouette needs id_col")
        values["silhouette"] = mean_silhouette(df, id_col, cols, cluster)
    elif silhouette == "squared":
        values["silhouette_squared"] = _squared_silhouette(data, found, centres, sizes)
    values["error"] = ""
    return spark.createDataFrame([tuple(values.values())], list(values))


def _squared_silhouette(data, found, centres, sizes) -> float:
    """Mean squared distance of x to cluster c is |x - m_c|^2 + spread_c, with spread_c = mean |y - m_c|^2."""
    spread = np.array([sum(j.s for j in r.js) for r in found])
    keys = [r.c for r in found]
    own = F.array_position(F.array(*[F.lit(c) for c in keys]), F.col("c"))
    sq = lambda m: F.aggregate(
        F.zip_with("x", F.array(*[F.lit(float(v)) for v in m]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v)
    dist = F.array(*[sq(m) + F.lit(float(s)) for m, s in zip(centres, spread)])
    size = F.element_at(F.array(*[F.lit(float(s)) for s in sizes]), own.cast("int"))
    rows = data.select(own.cast("int").alias("o"), size.alias("s"), dist.alias("d"))
    a = F.element_at("d", F.col("o")) * F.col("s") / F.greatest(F.col("s") - 1, F.lit(1.0))
    b = F.array_min(F.transform("d", lambda v, i: F.when(i + 1 != F.col("o"), v)))
    sil = F.when(F.col("s") == 1, 0.0).otherwise((b - a) / F.greatest(a, b))
    return rows.agg(F.avg(sil)).first()[0]

"""k-nearest-neighbour classification and regression on the exact block search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..core import Fitted, Operator
from ..functions.columns import class_index, class_map, class_value, names, require, sorted_classes
from ..plans.lineage import checkpointed
from ..plans.neighbors import METRICS, knn, points
from ..plans.skew import hot_safe_join


class _KNN(Operator):
    classify = False

    def __init__(self, cols, target, id_col, k=5, weights="uniform", metric="euclidean"):
        super().__init__()
        if weights not in ("uniform", "distance"):
            raise ValueError("weights must be uniform or distance")
        if metric not in METRICS:
            raise ValueError(f"metric must be one of {METRICS}")
        if k < 1:
            raise ValueError("k must be at least 1")
        self.cols, self.target, self.id_col, self.k, self.weights, self.metric = names(cols), target, id_col, int(k), weights, metric

    def _fit(self, df):
        require(df, [*self.cols, self.target, self.id_col])
        model = KNNModel(
            cols=self.cols, target=self.target, id_col=self.id_col, k=self.k, weights=self.weights, metric=self.metric,
            classes=sorted_classes(df, self.target) if self.classify else None,
        )
        model.train = df.select(*dict.fromkeys([self.id_col, self.target, *self.cols]))
        return model


class KNNClassifier(_KNN):
    classify = True


class KNNRegressor(_KNN):
    pass


class KNNModel(Fitted):
    """The training table is the state; it stays a distributed DataFrame."""

    train: DataFrame = None

    def to_json(self):
        raise ValueError("the state holds the training table; use save_fitted(spark, model, path)")

    def tables(self):
        return {"train": self.train}

    def attach(self, parts, tables):
        self.train = tables["train"]

    def neighbors(self, queries: DataFrame, id_col: str | None = None, exclude_self=False) -> DataFrame:
        """Long form: (query, neighbor, distance, rank). ``exclude_self`` leaves a query's own id out."""
        id_col = id_col or self.id_col
        k = self.k + 1 if exclude_self else self.k
        found = knn(points(self.train, self.id_col, self.cols, self.metric), points(queries, id_col, self.cols, self.metric), k, self.metric)
        if exclude_self:
            w = Window.partitionBy("query").orderBy("rank")
            found = found.where("query != neighbor").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= self.k)
        return found

    def transform_by(self, queries: DataFrame, id_col: str | None = None, exclude_self=False) -> DataFrame:
        """prediction, neighbor_distances, neighbor_ids (+ probabilities, class_probabilities for classes)."""
        id_col = id_col or self.id_col
        found = checkpointed(self.neighbors(queries, id_col, exclude_self))
        labels = self.train.select(F.col(f"`{self.id_col}`").cast("long").alias("neighbor"), F.col(f"`{self.target}`").alias("y"))
        found = hot_safe_join(found, labels, ["neighbor"])  # one row may be the neighbour of very many queries
        if self.weights == "uniform":
            weight = F.lit(1.0)
        else:  # a neighbour at distance 0 takes all the weight
            zero = F.min("distance").over(Window.partitionBy("query")) == 0
            weight = F.when(zero, F.when(F.col("distance") == 0, 1.0).otherwise(0.0)).otherwise(1.0 / F.col("distance"))
        found = found.withColumn("w", weight)
        listed = F.sort_array(F.collect_list(F.struct("rank", "distance", "neighbor")))  # k entries per query
        if self.classes is None:
            per = found.groupBy("query").agg(
                (F.sum(F.col("w") * F.col("y").cast("double")) / F.sum("w")).alias("prediction"), listed.alias("nn")
            )
        else:
            index = class_index(F.col("y"), self.classes)
            votes = [F.sum(F.when(index == i, F.col("w")).otherwise(0.0)).alias(f"v{i}") for i in range(len(self.classes))]
            per = found.groupBy("query").agg(*votes, F.sum("w").alias("all"), listed.alias("nn"))
            shares = F.array(*[F.col(f"v{i}") / F.col("all") for i in range(len(self.classes))])
            per = per.select("query", shares.alias("probabilities"), "nn")
            best = F.array_position("probabilities", F.array_max("probabilities")) - 1
            per = per.withColumn("prediction", class_value(best, self.classes))
            per = per.withColumn("class_probabilities", class_map(F.col("probabilities"), self.classes))
        per = per.withColumn("neighbor_distances", F.col("nn.distance")).withColumn("neighbor_ids", F.col("nn.neighbor"))
        per = per.drop("nn").withColumnRenamed("query", "_query")
        return queries.join(per, F.col(f"`{id_col}`").cast("long") == F.col("_query"), "left").drop("_query")

    def _transform(self, df):
        return self.transform_by(df)

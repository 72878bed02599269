"""Decision trees, random forests and gradient-boosted trees.

``max_depth=0`` means as deep as the library allows (30). Single trees with a criterion that ``pyspark.ml`` lacks
(``friedman_mse``, ``absolute_error``, ``poisson``), or with ``min_samples_split`` above 2, are grown level by level
(``plans.growth``); everything else is a ``pyspark.ml`` model. In forests and boosted trees, where ``min_samples_split``
has no direct counterpart, a leaf keeps at least ``min_samples_split // 2`` rows.
"""

from __future__ import annotations

import importlib
import json

import numpy as np
import pandas as pd
from pyspark.ml import classification as mlc, regression as mlr
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..core import Fitted, Operator
from ..functions.columns import (
    as_double, as_matrix_columns, class_index, class_map, class_value, feature_array, feature_vector, names, require, sorted_classes,
)
from ..plans.growth import descend, grow
from ..plans.lineage import checkpointed
from .linear import accuracy
from .metrics import regression_metrics

MAX_DEPTH = 30


class MLModel(Fitted):
    """A fitted ``pyspark.ml`` model behind the common output columns. Saved with the model's own writer."""

    model = None

    def to_json(self):
        raise ValueError("tree, kernel and network models are saved with save(path), not as JSON")

    def summary(self, spark):
        flat = {k: v for k, v in self.state.items() if isinstance(v, (int, float, str, bool))}
        return spark.createDataFrame([tuple(flat.values())], list(flat))

    def save(self, path: str) -> None:
        """State and the fitted model(s), each with Spark's own writers."""
        spark = SparkSession.getActiveSession()
        parts = self.model.models if isinstance(self.model, OneVsRestModel) else [self.model]
        for i, part in enumerate(parts):
            part.write().overwrite().save(f"{path}/model_{i}")
        kind = type(parts[0])
        row = (json.dumps(self.state), kind.__module__, kind.__name__, len(parts), isinstance(self.model, OneVsRestModel))
        spark.createDataFrame([row], "state string, module string, kind string, parts int, per_class boolean").write.mode("overwrite").parquet(f"{path}/state")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "MLModel":
        row = spark.read.parquet(f"{path}/state").first()
        if not row.module.startswith("pyspark.ml."):
            raise ValueError(f"unexpected model module {row.module}")
        kind = getattr(importlib.import_module(row.module), row.kind)
        parts = [kind.load(f"{path}/model_{i}") for i in range(row.parts)]
        out = MLModel(**json.loads(row.state))
        out.model = OneVsRestModel(parts) if row.per_class else parts[0]
        return out

    def save_native(self, path):
        self.save(path)

    def load_native(self, spark, path):
        self.model = MLModel.load(spark, path).model

    def importances(self, spark) -> DataFrame:
        values = [float(v) for v in self.model.featureImportances.toArray()]
        return spark.createDataFrame(list(zip(self.cols, values)), "feature string, importance double")

    def _transform(self, df):
        require(df, self.cols)
        out = self.model.transform(df.withColumn("_features", feature_vector(df, self.cols)))
        if self.classes is None:
            return out.withColumnRenamed("_prediction", "prediction").drop("_features")
        out = out.withColumn("prediction", class_value(F.col("_prediction"), self.classes))
        if "_probability" in out.columns:
            out = out.withColumn("probabilities", vector_to_array("_probability"))
            out = out.withColumn("class_probabilities", class_map(F.col("probabilities"), self.classes))
        return out.drop("_features", "_prediction", "_raw", "_probability")


class MLOperator(Operator):
    """Fit a ``pyspark.ml`` estimator on a cached (label, features) table."""

    classify = False

    def __init__(self, cols, target, with_score=True):
        super().__init__()
        self.cols, self.target, self.with_score = names(cols), target, with_score

    def estimator(self, classes, n: int):
        raise NotImplementedError

    def describe(self, model) -> dict:
        return {}

    def _fit(self, df):
        require(df, [*self.cols, self.target])
        classes = sorted_classes(df, self.target) if self.classify else None
        label = class_index(F.col(f"`{self.target}`"), classes).cast("double") if classes else as_double(df, self.target)
        data = df.select(label.alias("_label"), feature_vector(df, self.cols).alias("_features")).persist()
        try:
            n = data.count()
            fitted = self.estimator(classes, n).fit(data)
        finally:
            data.unpersist()
        out = MLModel(cols=self.cols, target=self.target, classes=classes, training_samples=n, **self.describe(fitted))
        out.model = fitted
        if self.with_score:
            if self.classify:
                out.state["accuracy"] = accuracy(out, df, self.target)
            else:
                out.state["r2_score"] = regression_metrics(out.transform(df), self.target, "prediction").first().r2
        return out

    def columns(self):
        base = {"featuresCol": "_features", "labelCol": "_label", "predictionCol": "_prediction"}
        return base | ({"probabilityCol": "_probability", "rawPredictionCol": "_raw"} if self.classify else {})


def _depth(max_depth) -> int:
    if max_depth and int(max_depth) > MAX_DEPTH:
        raise ValueError(f"max_depth is at most {MAX_DEPTH}")
    return int(max_depth) if max_depth else MAX_DEPTH


class _Tree(MLOperator):
    criteria: dict = {}

    def __init__(self, cols, target, max_depth=0, min_samples_split=2, min_samples_leaf=1, criterion=None, max_bins=64, seed=42, with_score=True):
        super().__init__(cols, target, with_score)
        criterion = criterion or next(iter(self.criteria))
        if criterion not in self.criteria:
            raise ValueError(f"criterion {criterion} is not supported; use one of {list(self.criteria)}")
        self.max_depth, self.criterion, self.max_bins, self.seed = max_depth, criterion, max_bins, seed
        self.impurity, self.min_split, self.min_rows = self.criteria[criterion], int(min_samples_split), max(int(min_samples_leaf), 1)

    def _fit(self, df):
        return super()._fit(df) if self.impurity and self.min_split <= 2 else self._grown(df)

    def _grown(self, df):
        require(df, [*self.cols, self.target])
        classes = sorted_classes(df, self.target) if self.classify else None
        label = class_index(F.col(f"`{self.target}`"), classes).cast("double") if classes else as_double(df, self.target)
        data = as_matrix_columns(df.withColumn("_label", label), self.cols, keep=["_label"])
        data = checkpointed(data.withColumn("_label", F.coalesce("_label", F.raise_error(F.lit(f"missing value in column {self.target}")).cast("double"))))
        nodes = grow(data, self.cols, "_label", self.criterion if self.impurity is None else GROWN_AS[self.impurity], _depth(self.max_depth), self.min_split,
                     self.min_rows, self.max_bins, classes=len(classes or []))
        leaves = [n for n in nodes if "feature" not in n]
        model = GrownTreeModel(
            cols=self.cols, target=self.target, classes=classes, criterion=self.criterion, training_samples=nodes[0]["n"], nodes=nodes,
            depth=max(n["id"].bit_length() - 1 for n in leaves), leaves=len(leaves),
        )
        if self.with_score and self.classify:
            model.state["accuracy"] = accuracy(model, df, self.target)
        elif self.with_score:
            model.state["r2_score"] = regression_metrics(model.transform(df), self.target, "prediction").first().r2
        return model

    def estimator(self, classes, n):
        kind = mlc.DecisionTreeClassifier if self.classify else mlr.DecisionTreeRegressor
        return kind(
            maxDepth=_depth(self.max_depth), minInstancesPerNode=self.min_rows, impurity=self.impurity, maxBins=self.max_bins,
            seed=self.seed, **self.columns(),
        )

    def describe(self, model):
        return {"depth": model.depth, "leaves": (model.numNodes + 1) // 2}


class DecisionTreeClassifier(_Tree):
    classify = True
    criteria = {"gini": "gini", "entropy": "entropy", "log_loss": "entropy"}


class DecisionTreeRegressor(_Tree):
    criteria = {"squared_error": "variance", "friedman_mse": None, "absolute_error": None, "poisson": None}


#: Names of the impurities in ``plans.growth``.
GROWN_AS = {"variance": "squared_error", "gini": "gini", "entropy": "entropy"}


class GrownTreeModel(Fitted):
    """A tree as a list of nodes; its JSON state is the whole model."""

    def importances(self, spark) -> DataFrame:
        """Each column's share of the impurity taken away, by rows."""
        held = [0.0] * len(self.cols)
        for n in self.nodes:
            if "feature" in n:
                held[n["feature"]] += n["n"] * n["gain"]
        whole = sum(held) or 1.0
        return spark.createDataFrame([(c, v / whole) for c, v in zip(self.cols, held)], "feature string, importance double")

    def node_table(self, spark) -> DataFrame:
        """One row per node: id, n, impurity, value (class shares: null), feature and threshold of its split."""
        rows = [(n["id"], n["n"], n["impurity"], None if self.classes else n["value"], self.cols[n["feature"]] if "feature" in n else None, n.get("threshold")) for n in self.nodes]
        return spark.createDataFrame(rows, "id long, n long, impurity double, value double, feature string, threshold double")

    def _transform(self, df):
        require(df, self.cols)
        nodes, values = self.nodes, np.array([n["value"] for n in self.nodes])

        @F.pandas_udf("double" if self.classes is None else "array<double>")
        def told(x: pd.Series) -> pd.Series:
            return pd.Series(list(values[descend(nodes, np.stack(x.to_numpy()))]) if len(x) else [])

        found = told(feature_array(df, self.cols))
        if self.classes is None:
            return df.withColumn("prediction", found)
        out = df.withColumn("probabilities", found)
        best = F.array_position("probabilities", F.array_max("probabilities")) - 1
        return out.withColumn("prediction", class_value(best, self.classes)).withColumn("class_probabilities", class_map(F.col("probabilities"), self.classes))


class _Forest(MLOperator):
    def __init__(self, cols, target, n_estimators=100, max_depth=0, min_samples_split=2, max_bins=64, seed=42, with_score=True):
        super().__init__(cols, target, with_score)
        self.trees, self.max_depth, self.max_bins, self.seed = int(n_estimators), max_depth, max_bins, seed
        self.min_rows = max(int(min_samples_split) // 2, 1)

    def estimator(self, classes, n):
        kind = mlc.RandomForestClassifier if self.classify else mlr.RandomForestRegressor
        return kind(
            numTrees=self.trees, maxDepth=_depth(self.max_depth), minInstancesPerNode=self.min_rows, maxBins=self.max_bins,
            featureSubsetStrategy="sqrt" if self.classify else "all", seed=self.seed, **self.columns(),
        )

    def describe(self, model):
        return {"n_estimators": model.getNumTrees}


class RandomForestClassifier(_Forest):
    classify = True


class RandomForestRegressor(_Forest):
    pass


class _Boosted(MLOperator):
    def __init__(self, cols, target, n_estimators=100, learning_rate=0.1, max_depth=3, min_samples_split=2, subsample=1.0, max_bins=64, seed=42, with_score=True):
        super().__init__(cols, target, with_score)
        self.settings = dict(
            maxIter=int(n_estimators), stepSize=float(learning_rate), maxDepth=_depth(max_depth), subsamplingRate=float(subsample),
            minInstancesPerNode=max(int(min_samples_split) // 2, 1), maxBins=max_bins, seed=seed,
        )

    def estimator(self, classes, n):
        if not self.classify:
            return mlr.GBTRegressor(**self.settings, **self.columns())
        cols = self.columns()
        probability, raw = cols.pop("probabilityCol"), cols.pop("rawPredictionCol")
        binary = mlc.GBTClassifier(**self.settings, **cols).setProbabilityCol(probability).setRawPredictionCol(raw)
        return binary if len(classes) <= 2 else OneVsRest(binary, len(classes))

    def describe(self, model):
        return {"n_estimators": self.settings["maxIter"]}


class GradientBoostingRegressor(_Boosted):
    pass


class GradientBoostingClassifier(_Boosted):
    classify = True


class OneVsRest:
    """One binary fit per class on the cached table; class shares are the normalised positive probabilities."""

    def __init__(self, binary, n_classes: int):
        self.binary, self.n_classes = binary, n_classes

    def fit(self, data):
        models = [
            self.binary.fit(data.withColumn("_label", F.when(F.col("_label") == c, 1.0).otherwise(0.0))) for c in range(self.n_classes)
        ]
        return OneVsRestModel(models)


class OneVsRestModel:
    def __init__(self, models):
        self.models = models

    def transform(self, df):
        out = df
        for c, m in enumerate(self.models):
            out = m.transform(out)
            positive = vector_to_array("_probability")[1] if "_probability" in out.columns else 1 / (1 + F.exp(-vector_to_array("_raw")[1]))
            out = out.withColumn(f"_share_{c}", positive).drop("_raw", "_prediction", "_probability")
        shares = [F.col(f"_share_{c}") for c in range(len(self.models))]
        whole = sum(shares[1:], shares[0])
        normed = F.array(*[F.when(whole > 0, s / whole).otherwise(F.lit(1.0 / len(shares))) for s in shares])
        best = (F.array_position(F.array(*shares), F.array_max(F.array(*shares))) - 1).cast("double")
        out = out.withColumn("_probability", array_to_vector(normed)).withColumn("_prediction", best)
        return out.drop(*[f"_share_{c}" for c in range(len(self.models))])

"""Headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once for the clock; the result is consumed by a noop write, so every output
column of every row is computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tablelearn.plans.lineage import drop_checkpoints  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "flagship", "standard_scaler_fit", "standard_scaler_fit_transform", "minmax_scaler_fit_transform", "robust_scaler_fit_transform",
    "label_encoder_fit_transform", "one_hot_fit_transform", "imputer_fit_transform", "polynomial_transform", "tfidf_fit_transform",
    "pca_fit_transform", "score_f_classif", "linear_regression_train", "linear_regression_predict", "logistic_predict_proba",
    "gaussian_nb_predict", "decision_tree_regressor_predict", "knn_classifier_predict", "knn_vectors_euclidean", "kmeans_fit_predict",
    "isolation_forest_train", "train_test_split", "train_test_split_stratified", "metrics_classification", "metrics_regression",
    "scoring_roc_auc", "cv_kfold", "grid_search", "chain_predict", "dbscan", "agglomerative", "spectral", "mean_shift",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true").config("spark.driver.memory", "20g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for attempt in range(2):
            began = time.time()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - began, 3)
            drop_checkpoints(spark)
    print(json.dumps({
        "metric": "headline operators, warm", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

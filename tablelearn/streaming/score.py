"""Apply a fitted, row-wise model to a stream: the same lazy projection as on a batch table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..core import Fitted
from ..operators.knn import KNNModel


def score_stream(model: Fitted, stream: DataFrame) -> DataFrame:
    """The model's columns on a streaming DataFrame. Models that search a table per batch are refused."""
    if not stream.isStreaming:
        raise ValueError("not a streaming DataFrame")
    if isinstance(model, KNNModel):
        raise ValueError("nearest-neighbour models need foreachBatch")
    return model.transform(stream)

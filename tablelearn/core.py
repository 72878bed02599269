"""Base classes: every operator is a ``pyspark.ml`` Estimator, every fitted state a ``pyspark.ml`` Model with JSON state."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession, functions as F


class Operator(Estimator):
    """An unfitted operator. ``fit(df)`` runs the distributed job(s) and returns a :class:`Fitted`."""

    def __init__(self):
        super().__init__()

    def fit_transform(self, df: DataFrame):
        model = self.fit(df)
        return model.transform(df), model


class Fitted(Model):
    """Fitted state. ``transform`` is lazy: it adds columns and starts no job."""

    registry: dict[str, type["Fitted"]] = {}

    def __init_subclass__(cls, **kw):
        super().__init_subclass__(**kw)
        Fitted.registry[cls.__name__] = cls

    def __init__(self, **state):
        super().__init__()
        self.state = state

    def __getattr__(self, name):
        state = self.__dict__.get("state", {})
        if name in state:
            return state[name]
        raise AttributeError(name)

    def to_json(self) -> str:
        return json.dumps({"kind": type(self).__name__, "state": self.state}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> "Fitted":
        parts = json.loads(text)
        return Fitted.registry[parts["kind"]](**parts["state"])

    def parts(self) -> dict[str, "Fitted"]:
        """Fitted models that this one holds, by name."""
        return {}

    def tables(self) -> dict[str, DataFrame]:
        """Distributed state, by name."""
        return {}

    def attach(self, parts: dict[str, "Fitted"], tables: dict[str, DataFrame]) -> None:
        """Take back what ``parts`` and ``tables`` gave."""

    def save_native(self, path: str) -> None:
        """Write state that has a writer of its own."""

    def load_native(self, spark: SparkSession, path: str) -> None:
        """Read what ``save_native`` wrote."""

    def summary(self, spark: SparkSession) -> DataFrame:
        """One row: the scalar and list state fields plus the whole state as JSON."""
        flat = {k: v for k, v in self.state.items() if v is not None and isinstance(v, (int, float, str, bool))}
        flat["model_json"] = self.to_json()
        return spark.createDataFrame([tuple(flat.values())], list(flat))

    def table(self, spark: SparkSession, *fields: str, key: str = "feature") -> DataFrame:
        """Long form of per-column state: one row per column name with the given list fields."""
        rows = list(zip(self.state["cols"], *[[float(v) for v in self.state[f]] for f in fields]))
        return spark.createDataFrame(rows, f"{key} string, " + ", ".join(f"{f} double" for f in fields))


def save_fitted(spark: SparkSession, model: Fitted, path: str) -> None:
    """Write any fitted state to a folder: JSON for the plain part, Parquet for tables, held models in sub-folders."""
    parts, tables = model.parts(), model.tables()
    row = (type(model).__name__, json.dumps(model.state, sort_keys=True), list(parts), list(tables))
    schema = "kind string, state string, parts array<string>, tables array<string>"
    spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{path}/fitted")
    for name, part in parts.items():
        save_fitted(spark, part, f"{path}/part_{name}")
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/table_{name}")
    model.save_native(f"{path}/native")


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """Read what :func:`save_fitted` wrote."""
    row = spark.read.parquet(f"{path}/fitted").first()
    model = Fitted.registry[row.kind](**json.loads(row.state))
    model.attach({n: load_fitted(spark, f"{path}/part_{n}") for n in row.parts}, {n: spark.read.parquet(f"{path}/table_{n}") for n in row.tables})
    model.load_native(spark, f"{path}/native")
    return model


def state_table(spark: SparkSession, model: Fitted) -> DataFrame:
    """The fitted state as a one-row table, ready for ``df.write.parquet``."""
    return spark.createDataFrame([(type(model).__name__, model.to_json())], "kind string, model_json string")


def state_from_table(df: DataFrame) -> Fitted:
    return Fitted.from_json(df.select("model_json").first()[0])


def guarded(spark: SparkSession, work: Callable[[], DataFrame], on_error: str = "raise") -> DataFrame:
    """Run ``work``; with ``on_error='row'`` a failure becomes one row holding the message."""
    if on_error not in ("raise", "row"):
        raise ValueError("on_error must be 'raise' or 'row'")
    try:
        return work()
    except Exception as exc:
        if on_error == "raise":
            raise
        return spark.createDataFrame([(str(exc),)], "error string")


def with_columns(df: DataFrame, new: dict) -> DataFrame:
    """Add many columns in one projection, replacing same-named ones."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    return df.select(*kept, *[e.alias(n) for n, e in new.items()])

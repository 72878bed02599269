"""Registry of the named queries: a Spark callable and, where SQL can express it, the equivalent DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablelearn.functions.columns import rounded as r
from tablelearn.sources.tables import spread, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


__all__ = ["DataFrame", "F", "ORACLES", "QUERIES", "query", "r", "spread", "table"]

"""Train/test splits and cross-validation folds as a key-hash filter: no sort of the rows, no shuffle of whole rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from ..functions.columns import class_index, require, sorted_classes
from ..plans.quantiles import integer_order_statistic, order_statistics
from ..plans.ranking import cut_number, hash_cuts, shuffle_key

FOLD_METHODS = ("kfold", "stratified", "shuffle")


def _shares(sizes: dict, fraction: float) -> dict:
    """ceil(fraction * n) rows in all, spread over the classes by largest remainder (ties: smaller class first)."""
    total = math.ceil(round(fraction * sum(sizes.values()), 9))
    exact = {c: n * fraction for c, n in sizes.items()}
    out = {c: math.floor(round(v, 9)) for c, v in exact.items()}
    rest = sorted(sizes, key=lambda c: (-round(exact[c] - out[c], 9), c))
    for c in rest[: total - sum(out.values())]:
        out[c] += 1
    return out


def _class_sizes(df: DataFrame, label: str, classes: list) -> dict:
    rows = df.groupBy(class_index(F.col(f"`{label}`"), classes).alias("g")).count().collect()
    if any(r.g is None for r in rows):
        raise ValueError(f"missing value in column {label}")
    return {r.g: r["count"] for r in rows}


def _sliced(df: DataFrame, id_col: str, seed: int, label: str | None, ranks) -> Column:
    """Slice number of every row: the row's place in hash order against the cuts ``ranks(size, group)`` gives."""
    key = shuffle_key(id_col, seed)
    if label is None:
        keys = df.select(F.lit(0).alias("g"), key.alias("k"))
        n = df.count()
        return cut_number(key, hash_cuts(keys, {0: ranks(n, 0)}, n)[0])
    classes = sorted_classes(df, label)
    sizes = _class_sizes(df, label, classes)
    index = class_index(F.col(f"`{label}`"), classes)
    cuts = hash_cuts(
        df.select(index.alias("g"), key.alias("k")), {g: ranks(n, g) for g, n in sizes.items()}, sum(sizes.values())
    )
    out = F.lit(None).cast("int")
    for g in sorted(cuts):
        out = F.when(index == g, cut_number(key, cuts[g])).otherwise(out)
    return out


def with_split(df: DataFrame, id_col: str, test_size=0.2, shuffle=True, stratify: str | None = None, seed=42) -> DataFrame:
    """Add ``_split`` ('train' or 'test'); exactly ceil(test_size * n) rows are test. ``id_col`` must be unique."""
    require(df, [id_col] + ([stratify] if stratify else []))
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    if not shuffle:
        if stratify:
            raise ValueError("stratify needs shuffle=True")
        n = df.count()
        n_test = math.ceil(round(test_size * n, 9))
        if n_test in (0, n):
            raise ValueError("a part of the split would be empty")
        if isinstance(df.schema[id_col].dataType, IntegralType):  # a double would merge ids above 2^53
            below = F.col(f"`{id_col}`") < F.lit(integer_order_statistic(df, id_col, n - n_test))
        else:
            value = F.col(f"`{id_col}`").cast("double")
            below = value < F.lit(order_statistics(df.select(value.alias("id")), ["id"], {0: [n - n_test]})[0, n - n_test])
        return df.withColumn("_split", F.when(below, "train").otherwise("test"))
    if stratify is None:
        part = _sliced(df, id_col, seed, None, lambda n, g: [math.ceil(round(test_size * n, 9))])
    else:
        sizes = _class_sizes(df, stratify, sorted_classes(df, stratify))
        share = _shares(sizes, test_size)
        part = _sliced(df, id_col, seed, stratify, lambda n, g: [share[g]])
    return df.withColumn("_split", F.when(part == 0, "test").otherwise("train"))


def train_test_split(df: DataFrame, id_col: str, test_size=0.2, shuffle=True, stratify: str | None = None, seed=42):
    """(train, test)."""
    tagged = with_split(df, id_col, test_size, shuffle, stratify, seed)
    return tagged.where("_split = 'train'"), tagged.where("_split = 'test'")


def _fold_starts(n: int, k: int) -> list[int]:
    """First rank of folds 1..k-1 when the first n mod k folds get one extra row."""
    size, extra = divmod(n, k)
    return [f * size + min(f, extra) for f in range(1, k)]


def with_folds(df: DataFrame, id_col: str, k=5, stratify: str | None = None, seed=42) -> DataFrame:
    """Add ``_fold`` (0..k-1), a fixed function of the id; with ``stratify`` every class is dealt out evenly."""
    if k < 2:
        raise ValueError("need at least 2 folds")
    return df.withColumn("_fold", _sliced(df, id_col, seed, stratify, lambda n, g: _fold_starts(n, k)))


def with_draws(df: DataFrame, id_col: str, repeats=5, test_size=0.2, seed=42) -> DataFrame:
    """Add ``_test_0`` .. flags: an independent draw of ceil(test_size * n) rows per repeat."""
    n = df.count()
    n_test = math.ceil(round(test_size * n, 9))
    out = df
    for r in range(repeats):
        out = out.withColumn(f"_test_{r}", _sliced(df, id_col, f"{seed}-{r}", None, lambda n, g: [n_test]) == 0)
    return out

"""Column helpers: strict numeric casts, null policy and vector arithmetic, all as JVM expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_CLASSES = 10_000


def names(cols: str | list[str]) -> list[str]:
    """Accept a list of names or one comma-separated string."""
    items = cols.split(",") if isinstance(cols, str) else list(cols)
    return [c.strip() for c in items if c.strip()]


def require(df: DataFrame, cols: list[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"column not found: {', '.join(missing)}")


def as_double(df: DataFrame, name: str) -> Column:
    """The column as double; text that is not a number is an error, null stays null."""
    raw = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        parsed = raw.try_cast("double")
        bad = F.raise_error(F.concat(F.lit(f"not a number in column {name}: "), raw)).cast("double")
        return F.when(raw.isNotNull() & parsed.isNull(), bad).otherwise(parsed)
    return raw.cast("double")


def as_matrix_columns(df: DataFrame, cols: list[str], on_null: str = "error", keep: list[str] | None = None) -> DataFrame:
    """Project ``keep`` + the numeric columns as double and apply the null policy ('error', 'drop', 'keep')."""
    require(df, cols + (keep or []))
    exprs = []
    for c in cols:
        x = as_double(df, c)
        if on_null == "error":
            x = F.coalesce(x, F.raise_error(F.lit(f"missing value in column {c}")).cast("double"))
        exprs.append(x.alias(c))
    out = df.select(*[F.col(f"`{k}`") for k in keep or [] if k not in cols], *exprs)
    return out.dropna(subset=cols) if on_null == "drop" else out


def is_array(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def feature_array(df: DataFrame, cols: list[str]) -> Column:
    """One array<double> column from scalar columns, or from a single array column."""
    require(df, cols)
    if len(cols) == 1 and is_array(df, cols[0]):
        arr = F.col(f"`{cols[0]}`").cast("array<double>")
        complete = arr.isNotNull() & ~F.exists(arr, lambda v: v.isNull())
        return F.when(complete, arr).otherwise(F.raise_error(F.lit(f"missing value in column {cols[0]}")))
    checked = [
        F.coalesce(as_double(df, c), F.raise_error(F.lit(f"missing value in column {c}")).cast("double")) for c in cols
    ]
    return F.array(*checked)


def feature_vector(df: DataFrame, cols: list[str]) -> Column:
    return array_to_vector(feature_array(df, cols))


def total(items: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, items) if items else F.lit(0.0)


def linear(cols: list[Column], weights: list[float], intercept: float = 0.0) -> Column:
    """intercept + sum(weight * column), left to right."""
    return total([F.lit(float(intercept))] + [c * F.lit(float(w)) for c, w in zip(cols, weights)])


def argmin(items: list[Column]) -> Column:
    """0-based position of the smallest item; the first one on a tie."""
    arr = F.array(*items)
    return (F.array_position(arr, F.array_min(arr)) - 1).cast("int")


def argmax(items: list[Column]) -> Column:
    arr = F.array(*items)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Round and turn -0.0 into 0.0 so that equal values print equally."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def sorted_classes(df: DataFrame, label: str) -> list:
    """Distinct non-null labels in natural order (numbers as numbers, text as text)."""
    require(df, [label])
    rows = df.select(F.col(f"`{label}`").alias("c")).where("c is not null").distinct().limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} distinct values; not a class column")
    return sorted(r.c for r in rows)


def class_index(label: Column, classes: list) -> Column:
    """0-based rank of the label in the sorted class list; null label is an error, unseen label gives null."""
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), label) - 1
    return F.when(position >= 0, position.cast("int"))


def class_value(index: Column, classes: list) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in classes]), index.cast("int") + 1)


def class_map(probabilities: Column, classes: list) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(str(c)) for c in classes]), probabilities)

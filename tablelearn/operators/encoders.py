"""Label and one-hot encoders."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder as MLOneHot, StringIndexer
from pyspark.sql import DataFrame, functions as F

from ..core import Fitted, Operator, with_columns
from ..functions.columns import names, require
from ..plans.lineage import checkpointed
from ..plans.ranking import running_total

INLINE_CLASSES = 64
BROADCAST_CLASSES = 100_000
DENSE_CATEGORIES = 1_000


class LabelEncoder(Operator):
    """Values as text, distinct values sorted, code = rank.

    Up to BROADCAST_CLASSES the class list is JSON state; beyond that it stays a distributed table ranked by
    range partitioning and is joined by shuffle.
    """

    def __init__(self, column, output=None, broadcast_classes=BROADCAST_CLASSES):
        super().__init__()
        self.column, self.output, self.broadcast_classes = column, output, broadcast_classes

    def _fit(self, df):
        require(df, [self.column])
        value = F.col(f"`{self.column}`").cast("string")
        value = F.coalesce(value, F.raise_error(F.lit(f"missing value in column {self.column}")).cast("string"))
        distinct = df.select(value.alias("label")).distinct()
        head = distinct.limit(self.broadcast_classes + 1).collect()
        output = self.output or f"{self.column}_encoded"
        if len(head) <= self.broadcast_classes:
            return LabelEncoderModel(column=self.column, output=output, classes=sorted(r.label for r in head))
        ranked = running_total(distinct.withColumn("one", F.lit(1)), ["label"], "one", "code").drop("one")
        model = LabelEncoderModel(column=self.column, output=output, classes=None)
        model.table = checkpointed(ranked)
        return model


class LabelEncoderModel(Fitted):
    table = None

    def to_json(self):
        if self.classes is None:
            raise ValueError("too many classes for JSON state; write mapping(spark) as a table instead")
        return super().to_json()

    def mapping(self, spark) -> DataFrame:
        """(label, code) table."""
        if self.classes is None:
            return self.table.select("label", F.col("code").cast("int").alias("code"))
        return spark.createDataFrame([(c, i) for i, c in enumerate(self.classes)], "label string, code int")

    def label_mapping(self) -> dict:
        return {c: i for i, c in enumerate(self.classes)}

    def _lookup(self, df, key, source, target, output):
        """Left join on the mapping; an unknown key is an error when the row is read."""
        mapping = self.mapping(df.sparkSession).select(F.col(source).alias("_k"), F.col(target).alias("_v"))
        side = mapping if self.classes is None else F.broadcast(mapping)  # JSON state is size-checked at fit
        joined = df.withColumn("_key", key).join(side, F.col("_key") == F.col("_k"), "left")
        unknown = F.raise_error(F.concat(F.lit("unseen value: "), F.coalesce(F.col("_key").cast("string"), F.lit("null"))))
        value = F.coalesce("_v", unknown.cast("int" if target == "code" else "string"))
        return joined.withColumn(output, value).drop("_key", "_k", "_v")

    def _transform(self, df):
        require(df, [self.column])
        key = F.col(f"`{self.column}`").cast("string")
        if self.classes is not None and len(self.classes) <= INLINE_CLASSES:
            at = F.array_position(F.array(*[F.lit(c) for c in self.classes]), key)
            unknown = F.raise_error(F.concat(F.lit("unseen value: "), F.coalesce(key, F.lit("null")))).cast("int")
            return df.withColumn(self.output, F.when(at > 0, (at - 1).cast("int")).otherwise(unknown))
        return self._lookup(df, key, "label", "code", self.output)

    def inverse_transform(self, df, column=None, output=None):
        column = column or self.output
        require(df, [column])
        return self._lookup(df, F.col(f"`{column}`").cast("int"), "code", "label", output or f"{column}_decoded")


def distinct_texts(df: DataFrame, cols: list[str], limit: int) -> list[list[str]]:
    """Sorted distinct values (as text) of every column, in one pass. More than ``limit`` in total is an error."""
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(cols)])
    rows = df.select(F.explode(cells).alias("e")).select("e.*").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} categories; use wide=True for a sparse vector")
    if any(r.v is None for r in rows):
        raise ValueError("missing value in a category column")
    return [sorted(r.v for r in rows if r.i == i) for i in range(len(cols))]


class OneHotEncoder(Operator):
    """Dense 0/1 columns ``<col>_<category>``, categories sorted. ``wide=True`` gives one sparse vector per
    column (``<col>_onehot``) for category counts where one column per category would be too many."""

    def __init__(self, cols, drop_first=False, handle_unknown="error", wide=False):
        super().__init__()
        if handle_unknown not in ("error", "ignore"):
            raise ValueError("handle_unknown must be error or ignore")
        self.cols, self.drop_first, self.handle_unknown, self.wide = names(cols), drop_first, handle_unknown, wide

    def _fit(self, df):
        require(df, self.cols)
        if self.wide:
            return self._fit_wide(df)
        found = distinct_texts(df, self.cols, DENSE_CATEGORIES)
        return OneHotEncoderModel(
            cols=self.cols, categories=found, drop_first=self.drop_first, handle_unknown=self.handle_unknown
        )

    def _fit_wide(self, df):
        keep = "error" if self.handle_unknown == "error" else "keep"
        stages = [
            StringIndexer(inputCol=c, outputCol=f"{c}_index", stringOrderType="alphabetAsc", handleInvalid=keep)
            for c in self.cols
        ]
        stages.append(MLOneHot(
            inputCols=[f"{c}_index" for c in self.cols], outputCols=[f"{c}_onehot" for c in self.cols],
            dropLast=keep == "keep", handleInvalid="error",
        ))
        return Pipeline(stages=stages).fit(df)


class OneHotEncoderModel(Fitted):
    def output_columns(self) -> list[str]:
        first = 1 if self.drop_first else 0
        return [f"{c}_{v}" for c, vs in zip(self.cols, self.categories) for v in vs[first:]]

    def _transform(self, df):
        require(df, self.cols)
        new = {}
        first = 1 if self.drop_first else 0
        for c, cats in zip(self.cols, self.categories):
            x = F.col(f"`{c}`").cast("string")
            known = x.isin(cats)
            if self.handle_unknown == "error":
                bad = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.coalesce(x, F.lit("null")))).cast("double")
                other = F.when(F.coalesce(known, F.lit(False)), 0.0).otherwise(bad)
            else:
                other = F.lit(0.0)
            for v in cats[first:]:
                new[f"{c}_{v}"] = F.when(x == F.lit(v), 1.0).otherwise(other)
        return with_columns(df, new)

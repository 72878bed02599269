"""TF-IDF over a bounded vocabulary: one grouped aggregate to fit, no shuffle to apply."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, functions as F

from ..core import Fitted, Operator
from ..functions.columns import require
from ..functions.text import add_terms


def _stop_list(stop_words):
    if stop_words is None or stop_words == "none":
        return None
    if stop_words == "english":
        return sorted(StopWordsRemover.loadDefaultStopWords("english"))
    return list(stop_words)


#: Words that n-grams are held to at most; where more words tie, all n-grams are counted.
FREQUENT_WORDS = 2_000
#: Rows times terms that are weighed at once.
DENSE_CELLS = 2_000_000


class TfidfVectorizer(Operator):
    """idf = ln((1 + n) / (1 + df)) + 1, rows scaled to length 1. The vocabulary is the ``max_features`` terms with
    the highest corpus count (ties: smaller term). ``stop_words``: 'english', 'none' or a list."""

    def __init__(self, text, max_features=100, ngram=(1, 1), stop_words="english", lowercase=True):
        super().__init__()
        if max_features < 1:
            raise ValueError("max_features must be at least 1")
        self.text, self.max_features, self.ngram, self.lowercase = text, int(max_features), tuple(ngram), lowercase
        self.stop_words = stop_words

    def _fit(self, df):
        require(df, [self.text])
        stop = _stop_list(self.stop_words)
        text = df.select(self.text)
        words = self._frequent(text, stop)
        terms = add_terms(text, self.text, "_terms", self.ngram, stop, self.lowercase, words)
        one = lambda n, d: lambda t: F.struct(t.alias("term"), F.lit(n).alias("n"), F.lit(d).alias("d"))
        marks = F.concat(F.transform("_terms", one(1, 0)), F.transform(F.array_distinct("_terms"), one(0, 1)))
        n = df.count()
        # explode_outer: a plain explode would add a size filter that evaluates the tokens twice
        top = (
            terms.select(F.explode_outer(marks).alias("e")).where("e.term is not null")
            .groupBy("e.term").agg(F.sum("e.n").alias("total"), F.sum("e.d").alias("df"))
            .orderBy(F.desc("total"), "term").limit(self.max_features).collect()
        )
        if not top:
            raise ValueError("empty vocabulary")
        top.sort(key=lambda r: r.term)
        return TfidfModel(
            text=self.text, terms=[r.term for r in top], idf=[math.log((1 + n) / (1 + r.df)) + 1 for r in top],
            counts=[r.total for r in top], ngram=list(self.ngram), stop_words=stop, lowercase=self.lowercase, documents=n,
        )

    def _frequent(self, text, stop) -> list[str] | None:
        """The words that a term of the vocabulary can hold: no n-gram occurs more often than each of its words, so words below
        the ``max_features``-th count take no part. None where single words are no terms, or where too many words tie."""
        lo, hi = self.ngram
        if lo != 1 or hi == 1 or self.max_features > FREQUENT_WORDS:
            return None
        words = add_terms(text, self.text, "_terms", (1, 1), stop, self.lowercase)
        counts = words.select(F.explode_outer("_terms").alias("term")).where("term is not null").groupBy("term").agg(F.count(F.lit(1)).alias("total"))
        found = counts.orderBy(F.desc("total")).limit(FREQUENT_WORDS + 1).collect()
        if len(found) < self.max_features:
            return [r.term for r in found]
        found = [r for r in found if r.total >= found[self.max_features - 1].total]
        return [r.term for r in found] if len(found) <= FREQUENT_WORDS else None


class TfidfModel(Fitted):
    def vocabulary(self, spark) -> DataFrame:
        rows = list(zip(self.terms, range(len(self.terms)), self.counts, self.idf))
        return spark.createDataFrame(rows, "term string, position int, total long, idf double")

    def _transform(self, df):
        """``tfidf_features`` map (non-zero terms) and dense ``tfidf_vector``."""
        require(df, [self.text])
        out = add_terms(df, self.text, "_terms", self.ngram, self.stop_words, self.lowercase)
        kept = F.filter("_terms", lambda t: t.isin(self.terms))
        out = out.withColumn("_weights", self._weigh()(kept)).drop("_terms")
        features = F.map_from_arrays("_weights.terms", "_weights.values")
        return out.withColumn("tfidf_features", features).withColumn("tfidf_vector", F.col("_weights.vector")).drop("_weights")

    def _weigh(self):
        """Counts of the vocabulary terms of each row times idf, scaled to length 1; sparse and dense form, many rows at once."""
        names, idf = pd.Index(self.terms, dtype=object), np.array(self.idf)
        step = max(1, DENSE_CELLS // len(idf))

        def block(rows: pd.Series) -> pd.DataFrame:
            sizes = rows.str.len().to_numpy(np.int64)
            at = names.get_indexer(np.concatenate(rows.to_list())) if sizes.any() else np.zeros(0, np.int64)
            place = np.repeat(np.arange(len(rows)), sizes) * len(idf) + at
            dense = np.bincount(place, minlength=len(rows) * len(idf)).reshape(len(rows), len(idf)) * idf
            size = np.sqrt((dense * dense).sum(axis=1))
            dense /= np.where(size > 0, size, 1)[:, None]
            row, column = np.nonzero(dense)
            cuts = np.searchsorted(row, np.arange(1, len(rows)))
            return pd.DataFrame({"terms": np.split(names.to_numpy()[column], cuts), "values": np.split(dense[row, column], cuts), "vector": list(dense)})

        @F.pandas_udf("struct<terms:array<string>,values:array<double>,vector:array<double>>")
        def weigh(rows: pd.Series) -> pd.DataFrame:
            if not len(rows):
                return pd.DataFrame({"terms": [], "values": [], "vector": []})
            return pd.concat([block(rows.iloc[k:k + step]) for k in range(0, len(rows), step)], ignore_index=True)

        return weigh


class HashedTfidf(Operator):
    """TF-IDF without a vocabulary: a term counts in the column that the first 32 bits of its MD5 name, modulo ``buckets``.
    The state is one number per column that occurs, whatever the number of terms; rows are maps from column to weight,
    scaled to length 1. Null and empty texts give empty maps."""

    def __init__(self, text, buckets=1 << 18, ngram=(1, 1), stop_words=None, lowercase=True):
        super().__init__()
        if not 1 <= buckets <= MAX_BUCKETS:
            raise ValueError(f"buckets must be between 1 and {MAX_BUCKETS}")
        self.text, self.buckets, self.ngram, self.stop_words, self.lowercase = text, int(buckets), tuple(ngram), stop_words, lowercase

    def _fit(self, df):
        require(df, [self.text])
        model = HashedTfidfModel(text=self.text, buckets=self.buckets, ngram=list(self.ngram), stop_words=_stop_list(self.stop_words), lowercase=self.lowercase)
        n = df.count()
        met = model.places(df.select(self.text)).select(F.explode_outer(F.array_distinct("_places")).alias("b")).where("b is not null")
        counts = sorted(met.groupBy("b").count().collect())  # at most one row a bucket
        model.state |= dict(documents=n, columns=[r[0] for r in counts], idf=[math.log((1 + n) / (1 + r[1])) + 1 for r in counts])
        return model


MAX_BUCKETS = 1 << 20


class HashedTfidfModel(Fitted):
    def places(self, df) -> DataFrame:
        out = add_terms(df, self.text, "_terms", tuple(self.ngram), self.stop_words, self.lowercase)
        place = lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10).cast("long") % self.buckets
        return out.withColumn("_places", F.transform("_terms", place)).drop("_terms")

    def _transform(self, df):
        """``tfidf_row``: map from column to weight. Columns that the fitted texts did not have are left out."""
        require(df, [self.text])
        columns, idf = np.array(self.columns, dtype=np.int64), np.array(self.idf)

        def row(places):
            met, counts = np.unique(places, return_counts=True)
            at = np.searchsorted(columns, met)
            known = at < len(columns)
            known[known] = columns[at[known]] == met[known]
            weight = counts[known] * idf[at[known]]
            return met[known], weight / max(math.sqrt((weight * weight).sum()), 1e-300)

        @F.pandas_udf("struct<columns:array<long>,weights:array<double>>")
        def weigh(places: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([row(np.asarray(p if p is not None else [], dtype=np.int64)) for p in places], columns=["columns", "weights"])

        out = self.places(df).withColumn("_weights", weigh("_places")).drop("_places")
        return out.withColumn("tfidf_row", F.map_from_arrays("_weights.columns", "_weights.weights")).drop("_weights")

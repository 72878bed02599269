"""Tokens and n-grams as JVM expressions, linear in the text even where the optimizer repeats them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TOKEN = r"[\p{L}\p{N}_]{2,}"


def add_terms(df: DataFrame, text: str, out: str, ngram=(1, 1), stop_words: list[str] | None = None, lowercase=True,
              words: list[str] | None = None) -> DataFrame:
    """Add ``out``: the document's n-grams in order. Stop words go before n-grams are formed; null text has none. With ``words``
    only the n-grams made of these are given; other words keep their place between them."""
    lo, hi = ngram
    if not 1 <= lo <= hi:
        raise ValueError("ngram must be (low, high) with 1 <= low <= high")
    raw = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    tokens = F.regexp_extract_all(F.lower(raw) if lowercase else raw, F.lit(TOKEN), F.lit(0))
    if stop_words:
        tokens = F.filter(tokens, lambda t: ~t.isin(stop_words))
    if words is not None:  # null in place of another word makes its n-grams null
        tokens = F.transform(tokens, lambda t: F.when(t.isin(words), t))
    if (lo, hi) == (1, 1):
        return df.withColumn(out, tokens if words is None else F.array_compact(tokens))
    df = df.withColumn("_tokens", tokens)
    grams = [_ngrams(F.col("_tokens"), n) for n in range(lo, hi + 1)]
    grams = F.concat(*grams)
    return df.withColumn(out, grams if words is None else F.array_compact(grams)).drop("_tokens")


def _ngrams(tokens: Column, n: int) -> Column:
    """Shifted copies of the token list glued element by element."""
    length = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    out = F.slice(tokens, 1, length)
    for shift in range(1, n):
        out = F.zip_with(out, F.slice(tokens, 1 + shift, length), lambda a, b: F.concat(a, F.lit(" "), b))
    return out

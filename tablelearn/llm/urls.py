"""URL filter: host and path rules, then a weighted vocabulary found by one Aho-Corasick pass."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

# The rules of the query's contract as (host, path, verdict).
RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
# Vocabulary: a strict term rejects alone, soft terms by the number of different ones.
STRICT = ["adult", "casino", "cheap-pills", "escort", "hentai", "nsfw", "porn", "porno", "pornography", "sex", "viagra", "xxx"]
SOFT = [
    "ads", "bet", "bets", "betting", "bonus", "cheap", "clicks", "cracked", "dating", "farm", "free", "hot", "keygen", "loan",
    "nude", "pills", "poker", "promo", "slots", "spam", "torrent", "track", "tracker", "warez", "win",
]
SOFT_HITS = 2


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null if none fits. A rule fits its host and all subdomains, if the
    path starts with the rule's path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # later ones are longer and win
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def vocabulary(strict, soft):
    """A function of a text: (hits of strict terms, number of different soft terms). A hit must not touch another
    letter or digit a-z, 0-9."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for term in sorted({*strict, *soft}):
        machine.add_word(term, (term, term in set(strict)))
    if len(machine):
        machine.make_automaton()
    inside = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

    def count(text: str) -> tuple[int, int]:
        hits, found = 0, set()
        for end, (term, is_strict) in machine.iter(text) if len(machine) else ():
            start = end - len(term)
            if (start < 0 or text[start] not in inside) and (end + 1 == len(text) or text[end + 1] not in inside):
                if is_strict:
                    hits += 1
                else:
                    found.add(term)
        return hits, len(found)

    return count


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, strict=STRICT, soft=SOFT,
               soft_hits: int = SOFT_HITS) -> DataFrame:
    """page_id, host, path, rule, verdict, strict_hits, soft_hits for every row.

    A fitting rule decides; otherwise one strict hit or ``soft_hits`` different soft ones block. The vocabulary looks at
    the whole url with A-Z lower-cased. A null or empty url has empty host and path, no rule and the verdict allow. Rows
    are judged one by one: repeated rows repeat, null ids stay, other columns are not read.
    """
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    @F.pandas_udf(T.StructType([T.StructField("strict_hits", T.IntegerType()), T.StructField("soft_hits", T.IntegerType())]))
    def hits(urls: pd.Series) -> pd.DataFrame:
        count = vocabulary(strict, soft)
        return pd.DataFrame([count((u or "").translate(upper)) for u in urls], columns=["strict_hits", "soft_hits"])

    url = F.col("url")
    seen = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    seen = seen.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), hits(url).alias("hits"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    bad = (F.col("hits.strict_hits") >= 1) | (F.col("hits.soft_hits") >= soft_hits)
    return seen.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(bad, "block").otherwise("allow")).alias("verdict"), "hits.strict_hits", "hits.soft_hits",
    )


def judge_sql(rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS) -> str:
    """The same in DuckDB: boundaries by regular expressions instead of the automaton."""
    low = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def times(term):  # overlapping neighbours share a boundary, so boundaries are doubled before counting
        return f"len(regexp_extract_all(' ' || regexp_replace(low, '([^a-z0-9])', '\\1\\1', 'g') || ' ', '[^a-z0-9]{doubled(term)}[^a-z0-9]'))"

    def doubled(term):
        return "".join(ch if ch.isalnum() else f"{ch}{ch}" for ch in term)

    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for h, p, _ in ordered]
    rule = "CASE " + " ".join(f"{f} '{h}{p}'" for f, (h, p, _) in zip(fits, ordered, strict=True)) + " END"
    says = "CASE " + " ".join(f"{f} '{v}'" for f, (_, _, v) in zip(fits, ordered, strict=True)) + " END"
    return f"""
    WITH parts AS (
      SELECT page_id, {low} AS low, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS raw,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    hits AS (
      SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
             CAST({" + ".join(times(t) for t in strict)} AS INTEGER) AS strict_hits,
             CAST({" + ".join(f"CAST({times(t)} > 0 AS INTEGER)" for t in soft)} AS INTEGER) AS soft_hits FROM parts)
    SELECT page_id, host, path, {rule} AS rule,
           coalesce({says}, CASE WHEN strict_hits >= 1 OR soft_hits >= {soft_hits} THEN 'block' ELSE 'allow' END) AS verdict,
           strict_hits, soft_hits
    FROM hits"""

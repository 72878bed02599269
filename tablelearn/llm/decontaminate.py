"""Benchmark decontamination: a prefix-filtered join of item windows with documents, with DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tablelearn.plans.lineage import checkpointed
from tablelearn.plans.skew import hot_safe_join

#: Words of a window; an item of fewer words is one window.
WINDOW = 10
#: Words of a shingle, the token of the join.
SHINGLE = 3
#: Rows of a table of keys that is broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words, once A-Z are lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), GAP), lambda w: w != "")


def _token(ws: Column, i: Column, size: int) -> Column:
    """Hash of the shingle of ``size`` words from place i on."""
    return F.xxhash64(F.lit(size), *[F.get(ws, i + j) for j in range(size)])


def _places(last: Column) -> Column:
    """0, 1, .. last; nothing if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, win, len): every window of ``window`` words of an item, or all its words if there are fewer."""

    def cut(ws):
        size = F.least(F.lit(window), F.size(ws))
        return F.when(size > 0, F.transform(_places(F.size(ws) - size), lambda i: F.struct(F.array_join(F.slice(ws, i + 1, size), " ").alias("win"), size.alias("len"))))

    each = items.select("item_id", F.explode(_let(words(F.col("text")), cut)).alias("w"))
    return each.select("item_id", "w.win", "w.len").distinct()


def _window_tokens(windows: DataFrame) -> DataFrame:
    """(wid, len, off, key): the shingles of each window with their places; a window shorter than a shingle is one."""
    ws = F.split("win", " ")

    def token(ws, size):
        return lambda i: F.struct(i.alias("off"), _token(ws, i, size).alias("key"))

    def tokens(ws):
        return F.coalesce(*[F.when(F.size(ws) >= size, F.transform(_places(F.size(ws) - size), token(ws, size))) for size in range(SHINGLE, 0, -1)])

    each = windows.select("wid", "len", F.explode(_let(ws, tokens)).alias("t"))
    return each.select("wid", "len", "t.off", "t.key")


def _row_key() -> list[Column]:
    """96 bits that name a row's id and text."""
    return [F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", "doc_id").alias("k2")]


def _bounded(table: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has few rows of fixed width."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def occurrences(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """(k1, k2, pos, rest, key): where a document has a shingle of any window; ``rest`` counts the words from there on."""
    keys = checkpointed(tokens.select("key").distinct())
    sizes = [r.size for r in tokens.select(F.least(F.lit(SHINGLE), F.col("len")).alias("size")).distinct().collect()]  # SHINGLE rows at most

    def token(ws, size):
        return lambda i: F.struct(i.alias("pos"), (F.size(ws) - i).alias("rest"), _token(ws, i, size).alias("key"))

    def tokens_of(ws):
        return F.concat(*[F.transform(_places(F.size(ws) - size), token(ws, size)) for size in sizes])

    if not sizes:
        return docs.sparkSession.createDataFrame([], "k1 long, k2 int, pos int, rest int, key long")
    each = docs.select(*_row_key(), F.explode(_let(words(F.col("text")), tokens_of)).alias("t")).select("k1", "k2", "t.pos", "t.rest", "t.key")
    return checkpointed(each.join(_bounded(keys, keys.count()), "key", "left_semi").select("k1", "k2", "pos", "rest", "key"))


def candidates(found: DataFrame, tokens: DataFrame) -> DataFrame:
    """(k1, k2, start, wid): a document holds the rarest shingle of a window at a place where the whole window fits.

    A window is contained only if all its shingles are, so with shingles ordered by rarity over all documents the prefix
    of length one is enough. Windows with a shingle that no document has are gone. The place of the shingle in the window
    gives the start; it must not lie before the text, nor the window's end behind it.
    """
    counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    ranked = tokens.join(counts, "key", "left").groupBy("wid", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "off")).alias("t"))
    prefix = checkpointed(ranked.where("t.n > 0").select("wid", "len", "t.key", "t.off"))
    joined = found.join(_bounded(prefix, prefix.count()), "key")
    return joined.where("pos >= off AND rest >= len - off").select("k1", "k2", (F.col("pos") - F.col("off")).alias("start"), "wid")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an occurrence of a window), n_items, items_sha256 (over
    the sorted, comma-joined ids), contaminated; ``items`` has item_id and text.

    Exact: candidates from the shingle join are compared word by word. Null and empty texts have no words and are clean;
    so is every document if there are no items with words. Windows that several items share count for each of them; an
    item without an id adds hit words, but no item. Equal rows get equal results, an empty table gives no rows, and only
    the columns named are read. No plan node makes more rows than the documents have words, and none depends on how many
    items share a passage but the list of ids itself.
    """
    owned = item_windows(items, window)
    names = F.sort_array(F.collect_set(F.col("item_id").cast("string")))
    windows = owned.groupBy("win", "len").agg(names.alias("ids")).withColumn("wid", F.md5("win"))
    # windows that the same items hold, as those of one passage do, share one list of ids
    windows = checkpointed(windows.withColumn("held_by", F.sha2(F.to_json("ids"), 256)))
    tokens = checkpointed(_window_tokens(windows))
    found = occurrences(docs, tokens)
    hits = checkpointed(candidates(found, tokens).distinct())
    held = hot_safe_join(hits, windows.select("wid", "win", "len", "held_by"), ["wid"])
    grouped = checkpointed(held.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("start", "len", "win", "held_by"))).alias("cands")))
    covered = checkpointed(_verified(docs, grouped))
    lists = windows.groupBy("held_by").agg(F.first("ids").alias("ids"))
    ids = hot_safe_join(covered.select("k1", "k2", F.explode("held_by").alias("held_by")), lists, ["held_by"])
    ids = ids.groupBy("k1", "k2").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))
    ids = ids.select("k1", "k2", F.size("ids").cast("long").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    result = covered.select("k1", "k2", "n_hit").join(ids, ["k1", "k2"])
    rows = docs.select("doc_id", *_row_key(), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    joined = hot_safe_join(rows, checkpointed(result), ["k1", "k2"], "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return joined.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def _verified(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """(k1, k2, n_hit, held_by: names of the lists of items) of the texts that really hold a window."""
    few = grouped.select("k1", "k2")
    texts = docs.select(*_row_key(), "text")
    texts = texts.join(_bounded(few, few.count()), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    joined = texts.join(grouped, ["k1", "k2"]).select("k1", "k2", "cands", words(F.col("text")).alias("ws"))

    def real(ws, cands):
        return F.filter(cands, lambda c: F.array_join(F.slice(ws, c["start"] + 1, c["len"]), " ") == c["win"])

    true = joined.select("k1", "k2", _let(F.col("ws"), lambda ws: real(ws, F.col("cands"))).alias("v")).where(F.size("v") > 0)

    def cover(a, c):
        end = (c["start"] + c["len"]).cast("long")
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["hit"] + F.greatest(F.lit(0), end - F.greatest(a["end"], c["start"].cast("long")))).alias("hit"))

    zero = F.lit(0).cast("long")
    hit = F.aggregate("v", F.struct(zero.alias("end"), zero.alias("hit")), cover, lambda a: a["hit"])
    return true.select("k1", "k2", hit.alias("n_hit"), F.array_distinct(F.transform("v", lambda c: c["held_by"])).alias("held_by"))


def contamination_sql(window: int = WINDOW) -> str:
    """The same in DuckDB's SQL, by windows of the documents."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"
    return f"""
WITH i AS (SELECT item_id, {low} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM (SELECT *, least({window}, len(w)) AS n FROM i) WHERE n > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {low} AS w FROM documents),
size AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, size WHERE len(w) >= n)),
occ AS (SELECT rid, p, iw.n, item_id FROM dw JOIN iw USING (n, win)),
hit AS (SELECT rid, count(DISTINCT spot) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS spot FROM (SELECT DISTINCT rid, p, n FROM occ)) GROUP BY rid),
its AS (SELECT rid, count(item_id) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS h FROM (SELECT DISTINCT rid, item_id FROM occ) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)"""

"""Consistent weighted sampling of words: document fingerprints with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablelearn.plans.lineage import checkpointed

SAMPLES = 64
#: Samples that one row of the inner table makes; it sets the size of the generated code, not the result.
BLOCK = 4
#: Rows of a bucket of neighbouring ids.
BUCKET_ROWS = 512
#: Bits of a hash for a uniform number.
BITS = 24
#: A sample is missed with a probability of exp(-REACH), 4 in 10^18.
REACH = 40.0
#: Bits of a sample that tell it from others.
NAMES = (1 << 22) - 1
_SPACE = r"[\x20\x09-\x0D]+"


def _point(bits: Column, shift: int) -> Column:
    """Midpoint of one of 2^BITS equal parts, from the bits of a hash; over 2^BITS it is uniform between 0 and 1."""
    return F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << BITS) - 1)) + F.lit(0.5)


def _draws(term: Column, k: Column, weight: Column, total: Column, name: str) -> list[Column]:
    """``r``, ``c`` and ``b`` of a term in sample k: two from Gamma(2, 1) and one uniform, all from a hash of (term, k).

    A sample is the term with the least a = c exp(-r (t - b + 1)), and that is at least c exp(-r) / weight. With
    exp(-r) = p and c = -ln q >= 1 - q, terms for which (1 - q) p / weight exceeds REACH / total are left out: the least a
    of a text of that total weight is exponentially distributed with this rate, so the sample is among them with a
    probability of exp(-REACH). Only the others need logarithms.
    """
    first, second = F.xxhash64(term, k), F.xxhash64(k, term)
    unit = F.lit(0.5 ** (2 * BITS))
    p = _point(first, 64 - BITS) * _point(first, 64 - 2 * BITS) * unit
    q = _point(second, 64 - BITS) * _point(second, 64 - 2 * BITS) * unit
    near = (F.lit(1.0) - q) * p * total <= weight * REACH
    rest = F.lit((1 << 64 - 2 * BITS) - 1)
    b = (first.bitwiseAND(rest) * (1 << 64 - 2 * BITS) + second.bitwiseAND(rest)) * F.lit(0.5 ** (128 - 4 * BITS))
    return [F.when(near, -F.log(p)).alias(f"r{name}"), F.when(near, -F.log(q)).alias(f"c{name}"), b.alias(f"b{name}")]


def _least(term: Column, log_w: Column, r: Column, c: Column, b: Column) -> Column:
    """Least over terms of a long with a in its upper part and 22 bits of (term, t) in its lower part."""
    t = F.floor(log_w / r + b)
    a = F.least(c * F.exp(r * (b - t - 1.0)), F.lit(60.0)) * float(1 << 35)
    name = (term.bitwiseAND(F.lit(NAMES)) + t * F.lit(1_000_003)).bitwiseAND(F.lit(NAMES))
    return F.min(F.shiftleft(a.cast("long"), 22) + name)


def _neighbours(docs: DataFrame, bucket_rows: int) -> DataFrame:
    """(bucket, real, place, doc_id, text, next_text): every row with the text of the next one by id, null ids last, the
    first after the last. Rows are dealt by ranges of ids; each bucket also gets the first row of the next bucket, which
    is marked by ``real`` = false, so that no row needs a join to find its neighbour."""
    facts = docs.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    buckets = max(1, -(-facts["n"] // bucket_rows))
    low, high = (facts["low"], facts["high"]) if facts["low"] is not None else (0, 0)
    width = float(high - low + 1) / buckets
    place = F.floor((F.col("doc_id").cast("double") - F.lit(float(low))) / F.lit(width)).cast("long")
    rows = docs.withColumn("bucket", F.coalesce(F.least(place, F.lit(buckets - 1)), F.lit(buckets)).cast("long"))
    # bucket -> the one before it, in two steps: inside spans of buckets, then over the spans
    firsts = rows.groupBy("bucket").agg(F.min("doc_id").alias("first")).withColumn("span", F.floor(F.col("bucket") / 4096))
    inside = W.partitionBy("span").orderBy("bucket")
    firsts = firsts.withColumn("before", F.lag("bucket").over(inside))
    spans = firsts.groupBy("span").agg(F.max("bucket").alias("last")).withColumn(
        "before_span", F.coalesce(F.lag("last").over(W.orderBy("span")), F.max("last").over(W.partitionBy())))
    firsts = checkpointed(firsts.join(spans, "span").select("first", F.coalesce("before", "before_span", F.lit(0)).alias("before")))
    guests = docs.join(firsts, docs["doc_id"].eqNullSafe(firsts["first"])).select(
        "doc_id", "text", F.coalesce("before", F.lit(0)).cast("long").alias("bucket"), F.lit(False).alias("real"))
    both = rows.select("doc_id", "text", "bucket", F.lit(True).alias("real")).unionByName(guests)
    order = W.partitionBy("bucket").orderBy(F.col("real").desc(), F.col("doc_id").asc_nulls_last(), "text")
    return both.select("bucket", "real", F.row_number().over(order).alias("place"), "doc_id", "text", F.lead("text").over(order).alias("next_text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    Terms are the words of the text, cut at ASCII white space; a term weighs its number of occurrences times
    its length. A fingerprint has ``samples`` (a multiple of 4) consistent weighted samples of four hexadecimal digits;
    likeness is the share of equal samples. Words are counted and sampled in the partitions that the neighbour search
    has made, so nothing but texts is shuffled before the samples of a document are complete.

    Null texts are empty; texts without words share the fingerprint of all f and are alike, others are not like them;
    null ids come last by id; rows of one id are ordered by text; of a single row the next is itself; an empty table
    gives no rows; other columns are not read.
    """
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = _neighbours(table, bucket_rows).withColumn("n_chars", F.length("text"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    head = F.substring("text", F.lit(1), F.col("n_chars") - cut)
    rows = rows.select("bucket", "real", "place", "doc_id", "text", "n_chars", head.alias("head"),
                       F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut).alias("tail"))
    edited = F.concat("head", "tail")
    # whole words that text and edited text share stand once, with both marks; the rest of either once more
    rest = F.length("head") - F.length(F.substring_index("head", " ", -1)) + 1
    parts = rows.select("bucket", "place", "text", edited.alias("edited"), rest.alias("rest")).select(
        "bucket", "place", F.split(F.substring("text", F.lit(1), F.col("rest") - 1), _SPACE).alias("both"),
        F.split(F.substring("text", F.col("rest"), F.length("text")), _SPACE).alias("one"),
        F.split(F.substring("edited", F.col("rest"), F.length("edited")), _SPACE).alias("other"))

    def size(*names):  # of all words together
        return sum((F.length(F.array_join(n, "")) for n in names[1:]), F.length(F.array_join(names[0], "")))

    words = parts.select("bucket", "place", F.least(size("both", "one"), size("both", "other")).cast("double").alias("total"), F.explode(F.array(*[
        F.struct(F.lit(here).alias("here"), F.lit(there).alias("there"), F.col(name).alias("words"))
        for name, here, there in (("both", 1, 1), ("one", 1, 0), ("other", 0, 1))])).alias("p"))
    words = words.select("bucket", "place", "total", "p.here", "p.there", F.explode("p.words").alias("word")).where("word <> ''")
    terms = words.select("bucket", "place", "total", "here", "there", F.xxhash64("word").alias("term"), F.length("word").alias("size"))
    counts = terms.groupBy("bucket", "place", "total", "term").agg(
        F.sum(F.col("here") * F.col("size")).alias("here"), F.sum(F.col("there") * F.col("size")).alias("there"))
    weighed = counts.select("bucket", "place", "total", "term", F.greatest("here", "there").cast("double").alias("weight"),
                            F.log(F.col("here").cast("double")).alias("here"), F.log(F.col("there").cast("double")).alias("there"))
    blocks = weighed.withColumn("block", F.explode(F.array(*[F.lit(b) for b in range(samples // BLOCK)])))
    draws = [d for i in range(BLOCK) for d in _draws(F.col("term"), F.col("block") * BLOCK + i, F.col("weight"), F.col("total"), str(i))]
    drawn = blocks.select("bucket", "place", "block", "term", "here", "there", *draws)
    found = drawn.groupBy("bucket", "place", "block").agg(*[
        _least(F.col("term"), F.col(side), F.col(f"r{i}"), F.col(f"c{i}"), F.col(f"b{i}")).alias(f"{side[0]}{i}")
        for i in range(BLOCK) for side in ("here", "there")])
    low = F.lit(NAMES)
    found = found.groupBy("bucket", "place").agg(F.array_sort(F.collect_list(F.struct(
        "block", F.array(*[F.col(f"h{i}").bitwiseAND(low) for i in range(BLOCK)]).alias("h"),
        F.array(*[F.col(f"t{i}").bitwiseAND(low) for i in range(BLOCK)]).alias("e")))).alias("s"))
    found = found.select("bucket", "place", F.flatten("s.h").alias("h"), F.flatten("s.e").alias("e"))
    none = F.array_repeat(F.lit(-1).cast("long"), samples)
    facts = rows.select("bucket", "place", "real", "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"))

    def filled(name):  # a text without words has no samples, and none of its columns a least value
        return F.when(F.get(F.col(name), 0).isNull(), none).otherwise(F.col(name))

    def text(name):
        return F.array_join(F.transform(name, lambda x: F.lpad(F.lower(F.hex(x.bitwiseAND(F.lit(65535)))), 4, "0")), "")

    def like(a, b):
        return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)) / F.lit(float(samples))

    order = W.partitionBy("bucket").orderBy("place")
    out = facts.join(found, ["bucket", "place"], "left").select("bucket", "place", "real", "doc_id", "n_chars", "edited_sha256", filled("h").alias("h"), filled("e").alias("e"))
    out = out.withColumn("next", F.lead("h").over(order)).where("real")
    return out.select("doc_id", "n_chars", "edited_sha256", text("h").alias("fingerprint"), text("e").alias("edited_fingerprint"),
                      like("h", "e").alias("near_edited"), like("h", "next").alias("near_next"))

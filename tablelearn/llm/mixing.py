"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tablelearn.plans.lineage import checkpointed

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
#: Random offsets drawn for a source; the one whose words come nearest the target is used.
OFFSETS = 32
BUCKET_ROWS = 10_000
WORDS = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size) -> and ``target``: all words shared by weight (the weights repeat over the sources in code
    point order, null last), none above ``max_repeat`` times its source, the excess shared again by weight.

    One row per source. With sources sorted by how much of their cap a unit of weight fills, the capped ones come
    first, so one running sum finds the common level.
    """
    place = W.orderBy(F.col("source").asc_nulls_last())
    by_fill = W.orderBy("_fill", F.col("source").asc_nulls_last())
    everything = W.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("_weight", weight).withColumn("_cap", F.lit(max_repeat) * F.col("source_size"))
    rows = rows.withColumn("_fill", F.col("_cap") / F.col("_weight"))
    left = F.sum("source_size").over(everything) - F.sum("_cap").over(by_fill.rowsBetween(W.unboundedPreceding, 0)) + F.col("_cap")
    rest = F.sum("_weight").over(by_fill.rowsBetween(0, W.unboundedFollowing))
    rows = rows.withColumn("_level", left / rest).withColumn("_open", F.col("_cap") > F.col("_weight") * F.col("_level"))
    level = F.min(F.when(F.col("_open"), F.struct(F.col("_fill"), F.col("source").isNull(), "source", "_level"))).over(everything)["_level"]
    share = F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_weight") * level, F.col("_cap").cast("double")))
    return rows.select("source", "source_size", share.alias("target"))


def _offset(source, k: int, seed: int):
    """Offset ``k`` of a source, from 0 to 1."""
    text = F.concat(F.lit(f"{seed}|{k}|"), F.coalesce(source, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        max_repeat: int = MAX_REPEAT, offsets: int = OFFSETS, seed: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken (= copies x size) for every row.

    Every document of a source expects target / source_size copies (at most ``max_repeat``). Documents stand in the
    order of md5(id); the running sum of expected copies plus the source's offset crosses an integer boundary once per
    copy. Each source draws ``offsets`` seeded offsets and uses the one whose words come nearest its target (the first
    of equals). The running number is a count per hash bucket plus a row number inside the bucket, so no source needs
    to fit one task, and the number of buckets never changes the result.

    Null or empty texts have size 0 and are taken like any other; a source without words has target 0 and no copies;
    null sources form one source, placed last; null ids sort first; rows repeated whole each count; an empty table gives
    no rows; other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    total, digits = docs.count(), 1
    while total > bucket_rows * 16 ** digits:
        digits += 1
    rows = checkpointed(rows.withColumn("_bucket", F.substring("_key", 1, digits)))
    buckets = rows.groupBy("source", "_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_words"))
    running = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    buckets = checkpointed(buckets.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0))))
    goal = targets(buckets.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, max_repeat)
    goal = goal.withColumn("_expect", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    goal = checkpointed(goal)
    places = buckets.alias("b").join(goal.alias("g"), F.col("b.source").eqNullSafe(F.col("g.source"))).select(
        F.col("b.source").alias("_source"), F.col("_bucket").alias("_place"), "_before", "source_size", "target", "_expect")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_place"))
    inside = W.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
    ranked = rows.join(places, same).withColumn("_rank", F.col("_before") + F.row_number().over(inside))
    ranked = checkpointed(ranked.select("doc_id", "source", "size", "source_size", "target", "_expect", "_rank"))

    def copies(offset):
        upto = F.col("_rank") * F.col("_expect") + offset
        before = (F.col("_rank") - 1) * F.col("_expect") + offset
        return (F.floor(upto) - F.floor(before)).cast("long")

    tries = ranked.groupBy("source").agg(
        F.first("target").alias("target"),
        *[F.sum(copies(_offset(F.col("source"), k, seed)) * F.col("size")).alias(f"_t{k}") for k in range(offsets)])
    best = F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"_t{k}") - F.col("target")).alias("miss"), F.lit(k).alias("k"), _offset(F.col("source"), k, seed).alias("offset"))
        for k in range(offsets)]))["offset"]
    chosen = checkpointed(tries.select(F.col("source").alias("_source"), best.alias("_offset")))
    out = ranked.join(chosen, F.col("source").eqNullSafe(F.col("_source"))).withColumn("copies", copies(F.col("_offset")))
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_sql(weights=WEIGHTS, max_repeat: int = MAX_REPEAT, offsets: int = OFFSETS, seed: int = 0) -> str:
    weight = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {} {} END".format(
        len(weights), " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(weights)))
    return f"""
    WITH sized AS (
      SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
    sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, {max_repeat} * source_size AS cap, {weight} AS weight FROM sources),
    filled AS (
      SELECT *, (sum(source_size) OVER () - sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) + cap)
             / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM weighed),
    level AS (SELECT level FROM filled WHERE cap > weight * level ORDER BY cap / weight, source NULLS LAST LIMIT 1),
    goal AS (
      SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce(weight * (SELECT level FROM level), CAST(cap AS DOUBLE))) AS target
      FROM filled),
    ranked AS (
      SELECT s.doc_id, s.source, s.size, g.source_size, g.target,
             CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0::DOUBLE END AS expect,
             row_number() OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size) AS r
      FROM sized s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
    draws AS (
      SELECT source, target, d AS k,
             CAST(('0x' || substr(md5('{seed}|' || d || '|' || coalesce(source, '')), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM goal, range({offsets}) t(d)),
    tried AS (
      SELECT w.source, w.k, w.u, abs(sum((floor(r.r * r.expect + w.u) - floor((r.r - 1) * r.expect + w.u)) * r.size) - any_value(w.target)) AS miss
      FROM draws w JOIN ranked r ON w.source IS NOT DISTINCT FROM r.source GROUP BY w.source, w.k, w.u),
    chosen AS (SELECT source, u FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY miss, k) AS best FROM tried) WHERE best = 1)
    SELECT r.doc_id, r.source, r.size, r.source_size, r.target,
           CAST(floor(r.r * r.expect + c.u) - floor((r.r - 1) * r.expect + c.u) AS BIGINT) AS copies,
           CAST(floor(r.r * r.expect + c.u) - floor((r.r - 1) * r.expect + c.u) AS BIGINT) * r.size AS taken
    FROM ranked r JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source"""


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns stay. Rows that share id, source and size stand in
    any order for each other: of such a group as many rows come as the mix takes of the group."""

    def keys(doc_id, source, size):  # without nulls, so that join and row number share one shuffle
        return [F.coalesce(doc_id.cast("string"), F.lit("")).alias("id"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("of"), size.alias("size")]

    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = docs.select(row, *keys(F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string"), size))
    taken = mix(docs, id_col, text_col, source_col, **options).select("copies", *keys(F.col("doc_id"), F.col("source"), F.col("size")))
    same = ["id", "of", "size"]
    counts = taken.groupBy(*same).agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")).where("copies > 0")
    found = marked.join(counts, same).withColumn("nth", F.row_number().over(W.partitionBy(*same).orderBy("rows")))
    share = F.floor(F.col("nth") * F.col("copies") / F.col("rows")) - F.floor((F.col("nth") - 1) * F.col("copies") / F.col("rows"))
    found = found.withColumn("share", share.cast("int")).where("share > 0")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("share"))))
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

"""Merkle manifest of a dataset: eight-way hash trees whose levels are kept as hex strings of aligned blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablelearn.plans.lineage import checkpointed

#: Children of a node.
ARITY = 8
#: Levels that a block holds, and the nodes of its lowest one.
LEVELS = 3
BLOCK = ARITY**LEVELS
#: Hex digits of a digest, and of the digests of one run.
HEX = 64
RUN = ARITY * HEX
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.transform(F.array(value), body)[0]


def digest(*fields: Column) -> Column:
    """SHA-256 (lowercase hex) over the fields: ``-`` for null, else UTF-8 byte count, ``:`` and value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos`` (0-based place in the group ``g`` by ``order``) and ``total`` (rows of the group).

    Rows are range-partitioned by group and order; ``salt`` spreads rows that are equal in everything. Only counts for
    each group and slice are compared across slices.
    """
    sliced = checkpointed(rows.repartitionByRange("g", *order, "salt").withColumn("slice", F.spark_partition_id()))
    group = Window.partitionBy("g")
    before = F.sum("n").over(group.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sliced.groupBy("g", "slice").agg(F.count(F.lit(1)).alias("n")).select(
        "g", "slice", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(group).alias("total")
    )
    inside = F.row_number().over(Window.partitionBy("g", "slice").orderBy(*order, "salt")) - 1
    return sliced.withColumn("inside", inside).join(offsets, ["g", "slice"]).select(
        *[c for c in rows.columns if c != "salt"], (F.col("before") + F.col("inside")).alias("pos"), "total"
    )


def _parents(level: Column) -> Column:
    """The level above: each run of up to eight digests, a fixed-width substring, becomes its own digest."""
    runs = F.ceil(F.length(level) / F.lit(RUN)).cast("int")
    each = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256))
    return F.array_join(each, "")


def _raised(j: int) -> Callable[[Column], Column]:
    """Adds the level above the j-th where the block goes that high."""
    return lambda done: F.when(F.col("height") > j, F.concat(done, F.array(_parents(done[j])))).otherwise(done)


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per aligned block of BLOCK nodes: its items in order and the hex strings of its levels.

    A group with more than one block has LEVELS levels in each; a group of one block as many as lead to one node.
    """
    block = F.floor(F.col("pos") / BLOCK)
    grouped = nodes.groupBy("g", block.alias("block")).agg(
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("pos", "node", "load"))).alias("items")
    )
    heights = sum((F.when(F.col("total") > ARITY**j, 1).otherwise(0) for j in range(1, LEVELS)), F.when(F.col("total") > 1, 1).otherwise(0))
    grouped = grouped.withColumn("height", heights)
    levels = F.array(F.array_join(F.transform("items", lambda x: x["node"]), ""))
    for j in range(LEVELS):
        levels = _let(levels, _raised(j))
    return checkpointed(grouped.withColumn("levels", levels))


def _own_path(x: Column) -> Column:
    """For an item of a block: on each level the digests left and right of its node within the run."""
    at = (x["pos"] % BLOCK).cast("int")
    steps = []
    for j in range(LEVELS):
        node = F.shiftright(at, 3 * j)
        run = F.substring(F.element_at("levels", j + 1), F.shiftright(node, 3) * RUN + 1, F.lit(RUN))
        left = node.bitwiseAND(F.lit(ARITY - 1)) * HEX
        steps.append(F.struct(F.substring(run, F.lit(1), left).alias("l"), F.substring(run, left + HEX + 1, F.lit(RUN)).alias("r")))
    return F.concat(*[F.when(F.col("height") > j, F.array(s)).otherwise(F.array().cast("array<struct<l:string,r:string>>")) for j, s in enumerate(steps)])


def _climb(nodes: DataFrame, top: Callable[[DataFrame], DataFrame], item: Callable[[Column, Column], Column]) -> DataFrame:
    """``nodes`` (g, pos, total, node, load) -> one row per node: g, pos, subroot, root and the fields of ``item(x, path)``.

    Blocks become single nodes and these are climbed in the same way, so a group of n nodes takes log(n) / log(BLOCK)
    rounds; the path of a block from above is joined to it before its items are unfolded. ``top`` maps the single node of
    each group (g, node) to (g, path, root).
    """
    most = nodes.agg(F.max("total")).first()[0]
    if most is None or most == 1:
        above = top(nodes.select("g", "node"))
        blocks = nodes.select("g", F.array(F.struct("pos", "node", "load")).alias("items"), F.lit(0).alias("height"), F.array("node").alias("levels"), F.col("node").alias("subroot"))
        joined = blocks.join(above, "g")
    else:
        blocks = _blocks(nodes)
        up = blocks.select("g", F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).alias("total"), F.element_at("levels", -1).alias("node"), F.lit(None).cast("string").alias("load"))
        above = _climb(up, top, lambda x, path: F.struct(path.alias("path"))).withColumnRenamed("pos", "block")
        joined = blocks.join(above, ["g", "block"])
    each = F.transform("items", lambda x: F.struct(x["pos"].alias("pos"), _let(F.concat(_own_path(x), F.col("path")), lambda path: item(x, path)).alias("out")))
    return joined.select("g", "subroot", "root", F.explode(each).alias("x")).select("g", "x.pos", "subroot", "root", "x.out.*")


def _over_groups(subroots: DataFrame) -> DataFrame:
    """(g, node) -> (g, path, root): the tree over the groups' roots, in the order of ``g``."""
    rows = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "node", F.rand(5).alias("salt"))
    placed = _placed(checkpointed(rows), ["name"]).withColumn("load", F.struct("name"))
    ended = _climb(placed, lambda last: last.select("g", F.array().cast("array<struct<l:string,r:string>>").alias("path"), F.col("node").alias("root")),
                   lambda x, path: F.struct(x["load"]["name"].alias("name"), path.alias("path")))
    return checkpointed(ended.select(F.col("name").alias("g"), "path", "root"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["l"], node, s["r"]), 256))


def manifest(docs: DataFrame, fields=FIELDS, group="lang", order="doc_id", claim: Column | None = None, paths: bool = False) -> DataFrame:
    """One row per document: ``order`` column, leaf, subroot of its group, root, proof_sha256, folded_root, verified.

    A leaf is the digest of ``fields``. In each ``group`` leaves ascend by ``order`` (null first; ties: by leaf, and rows
    equal in all fields are alike), and every eight consecutive nodes become their digest until one is left; the groups'
    roots, null first, then by UTF-8 bytes, give the root in the same way. ``claim`` is a leaf to verify against the
    tree (default: the own one; null: the own one), folded with the original siblings. ``proof_sha256`` is the digest of
    all siblings up to the root; ``paths=True`` adds them as ``path``, pairs of hex strings left and right of the node.

    Null fields count as ``-`` (an empty text as ``0:``), repeated rows are leaves of their own, a lone document's leaf
    is subroot and root, an empty table gives no rows. Only the columns named are read; others may have any name. A
    text is read once; what moves between tasks are digests, 512 to a block.
    """
    leaf = digest(*[F.col(f"`{c}`") for c in fields])
    key = F.col(f"`{group}`").cast("string")
    rows = docs.select(
        F.when(key.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), key)).alias("g"), F.col(f"`{order}`").alias("by"), leaf.alias("node"),
        (F.lit(None).cast("string") if claim is None else claim).alias("claim"), F.rand(3).alias("salt"),
    )
    placed = _placed(checkpointed(rows), ["by", "node"])
    placed = placed.select("g", "pos", "total", "node", F.struct("by", "claim").alias("load"))

    def item(x, path):
        out = [
            x["load"]["by"].alias(order), x["node"].alias("leaf"),
            F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["l"], s["r"])), ""), 256).alias("proof_sha256"),
            folded(F.coalesce(x["load"]["claim"], x["node"]), path).alias("folded_root"),
        ]
        return F.struct(*out, *([path.alias("path")] if paths else []))

    out = _climb(checkpointed(placed), _over_groups, item)
    return out.select(order, "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), *(["path"] if paths else []))


def tampered_leaf() -> Column:
    """The leaf of a ``documents`` row whose text is lower-cased (A-Z) where 3 divides the CRC-32 of the decimal id."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    return digest(*[text if c == "text" else F.col(c) for c in FIELDS])


def manifest_sql() -> str:
    """The same in DuckDB's SQL: levels by recursion, one aggregate for each."""
    crc = """list_reduce([4294967295::BIGINT] || [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT FOR i IN range(1, length(doc_id::VARCHAR) + 1)],
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))"""

    def leaf(text):
        parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in [text if f == "text" else f for f in FIELDS]]
        return f"sha256({' || '.join(parts)})"

    low = f"translate(text, '{_UPPER}', '{_LOWER}')"
    climb = """SELECT g, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (m + 7) // 8 FROM {t} WHERE m > 1 GROUP BY g, lvl, idx // 8, m"""
    return f"""
WITH RECURSIVE crc AS (SELECT *, xor({crc}, 4294967295) % 3 = 0 AS hit FROM documents),
d AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {leaf('text')} AS leaf,
             CASE WHEN hit THEN {leaf(low)} ELSE {leaf('text')} END AS claim FROM crc),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS m,
             row_number() OVER () AS rid FROM d),
t(g, lvl, idx, h, m) AS (SELECT g, 0, pos, leaf, m FROM p UNION ALL {climb.format(t='t')}),
sub AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS m FROM t WHERE m = 1),
u(g, lvl, idx, h, m) AS (SELECT 'all', 0, pos, h, m FROM sub UNION ALL {climb.format(t='u')}),
s AS (SELECT rid, lvl, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < pos >> (3 * lvl)), '') AS l,
             coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > pos >> (3 * lvl)), '') AS r
      FROM p JOIN t ON t.g = p.g AND t.m > 1 AND t.idx >> 3 = p.pos >> (3 * lvl + 3) GROUP BY rid, lvl
      UNION ALL
      SELECT rid, 100 + lvl, coalesce(string_agg(u.h, '' ORDER BY idx) FILTER (idx < sub.pos >> (3 * lvl)), ''),
             coalesce(string_agg(u.h, '' ORDER BY idx) FILTER (idx > sub.pos >> (3 * lvl)), '')
      FROM p JOIN sub ON sub.g = p.g JOIN u ON u.m > 1 AND u.idx >> 3 = sub.pos >> (3 * lvl + 3) GROUP BY rid, lvl),
step AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY lvl) AS k FROM s),
f(rid, k, h) AS (SELECT rid, 0, claim FROM p UNION ALL SELECT f.rid, f.k + 1, sha256(l || h || r) FROM f JOIN step ON step.rid = f.rid AND step.k = f.k + 1),
ended AS (SELECT rid, arg_max(h, k) AS folded_root FROM f GROUP BY rid),
proof AS (SELECT p.rid, sha256(coalesce(string_agg(l || r, '' ORDER BY k), '')) AS proof_sha256 FROM p LEFT JOIN step ON step.rid = p.rid GROUP BY p.rid)
SELECT doc_id, leaf, sub.h AS subroot, u.h AS root, proof_sha256, folded_root, folded_root = u.h AS verified
FROM p JOIN sub ON sub.g = p.g JOIN u ON u.m = 1 JOIN ended ON ended.rid = p.rid JOIN proof ON proof.rid = p.rid"""

"""Near-duplicate groups: BagMinHash signatures of shingle multisets, banding, exact check of multiset overlap."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tablelearn.plans.components import components
from tablelearn.plans.lineage import checkpointed

from .memory import tidy
from .shingles import WORDS, WordHash, elements, mix, row_key, runs, shingles

SIMILARITY = 0.8
#: At similarity 0.8 two documents miss all bands with probability (1 - 0.8^6)^42, about 3 in a million.
BANDS = 42
ROWS = 6
#: Texts of a block in the second check.
BLOCK_NODES = 2048
_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Open interval (0, 1) from the upper 53 bits."""
    return ((bits >> _U(11)).astype(np.float64) + 0.5) / 9007199254740992.0


def signatures(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, slots: int) -> np.ndarray:
    """One row of ``slots`` 64-bit registers per text: the probability that two texts agree in a register is their
    weighted Jaccard similarity.

    The weights 0..w of an element are cut into the intervals (0,1], (1,2], (2,4], (4,8] ..., each with its own Poisson
    process of a rate equal to the interval's length, so that equal parts of two weights share their points. A point
    has a time, a slot and a level inside its interval, and counts if the level is within the weight. A register holds
    the earliest point of its slot. Points are drawn up to a time at which all slots are very likely taken; texts with
    a slot still open go on with twice the time.
    """
    out = np.zeros((texts, slots), _U)
    total = np.bincount(owner, weights=weight, minlength=texts)
    horizon = np.zeros(texts)
    busy = total > 0
    horizon[busy] = slots * (np.log(slots) + 4.0) / total[busy]
    parts, top = [], int(weight.max()) if len(weight) else 0
    low, span, k = 0, 1, 0
    while low < top:
        at = np.flatnonzero(weight > low)
        parts.append((at, np.full(len(at), low), np.full(len(at), span), np.full(len(at), k)))
        low, span, k = low + span, low + span, k + 1
    if not parts:
        return out
    at, low_, span_, k_ = (np.concatenate(x) for x in zip(*parts, strict=True))
    seed = mix(value[at] + (k_.astype(_U) + _U(1)) * _GOLD)
    text, limit = owner[at], weight[at]
    todo = np.ones(texts, bool)
    while todo.any():
        keep = todo[text]
        out_here, open_ = _earliest(text[keep], seed[keep], low_[keep], span_[keep], limit[keep], horizon, texts, slots)
        done = todo & busy & ~open_
        out[done] = out_here[done]
        todo = todo & busy & open_
        horizon = horizon * 2
    return out


def _earliest(text, seed, low, span, limit, horizon, texts, slots):
    best, register = np.full(texts * slots, np.inf), np.zeros(texts * slots, _U)
    time, step = np.zeros(len(text)), 0
    while len(text):
        step += 1
        bits = mix(seed + _U(step * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(_uniform(bits)) / span
        on = time <= horizon[text]
        text, seed, low, span, limit, time, bits = (x[on] for x in (text, seed, low, span, limit, time, bits))
        more = mix(bits + _U(1))
        level = low + span * _uniform(more << _U(32))
        counts = level <= limit
        at = (text * slots + ((more >> _U(32)) * _U(slots) >> _U(32)).astype(np.int64))[counts]
        when, name = time[counts], bits[counts]
        np.minimum.at(best, at, when)
        won = when == best[at]
        register[at[won]] = name[won]
    return register.reshape(texts, slots), np.isinf(best.reshape(texts, slots)).any(axis=1)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.tile(np.arange(bands, dtype=_U) * _GOLD, (len(signature), 1))
    for r in range(rows):
        keys = mix(keys + signature[:, r::rows][:, :bands])
    return keys.view(np.int64)


def _digest(text):
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.xxhash64(low).alias("d1"), F.xxhash64(F.lit(1), low, F.length(low)).alias("d2")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, words: int = WORDS,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, row_key, d1, d2, class_id, kept for every row.

    Two documents link if the multiset Jaccard similarity of their ``words``-word shingles (lower-cased, cut at white
    space) is at least ``similarity``; classes are the connected components, named by their smallest id, whose document
    is kept. Texts equal but for case are one node from the start, so copies never meet each other. Inside a bucket of
    a band every text is first checked against one text only; after the components of these links are known, only
    texts of one bucket that are in different components are checked again, in blocks, so no link between different
    texts of a bucket is lost and no pairs of all members of a group are made.

    Texts without words are copies of each other if equal; null texts are empty; a null id is replaced as ``row_key``
    states and stays null in the result; rows repeated whole get the same answer (and all say kept); an empty table
    gives no rows; other columns are not read.
    """
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = table.select("doc_id", row_key("doc_id", "text").alias("row_key"), *_digest(F.col("text")), "text")

    def sign(parts):
        memo = WordHash()
        for part in parts:
            for start in range(0, len(part), 256):
                some = part.iloc[start:start + 256]
                unique = some.drop_duplicates(["d1", "d2"])
                owner, value = shingles(unique["text"], memo, words)
                first, many = runs(owner, value)
                keys = band_keys(signatures(owner[first], value[first], many, len(unique), bands * rows), bands, rows)
                size = np.bincount(owner, minlength=len(unique))
                found = unique[["d1", "d2"]].assign(size=size, bands=[k if n else k[:0] for k, n in zip(keys, size, strict=True)])
                yield some[["doc_id", "row_key", "d1", "d2"]].merge(found, on=["d1", "d2"])

    signed = checkpointed(table.mapInPandas(lambda parts: tidy(sign(parts)), "doc_id long, row_key long, d1 long, d2 long, size long, bands array<long>"))
    nodes = checkpointed(signed.groupBy("d1", "d2").agg(F.min("row_key").alias("node"), F.first("size").alias("size"), F.first("bands").alias("bands")))
    banded = nodes.select("node", "size", F.explode("bands").alias("key"))
    many = banded.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    members = checkpointed(banded.join(many, "key"))
    # every text is tried against the text of its buckets that has the most company, the likeliest centre of its group
    company = members.groupBy("node").agg(F.sum("many").alias("company"))
    centre = F.max_by("node", F.struct("company", -F.col("node"))).alias("low")
    members = checkpointed(members.join(members.join(company, "node").groupBy("key").agg(centre), "key").drop("many"))

    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("d1", "d2", F.col("node").alias("row_key"))

    def spell(parts):
        memo = WordHash()
        for part in parts:
            for start in range(0, len(part), 256):
                some = part.iloc[start:start + 256]
                yield pd.DataFrame({"node": some["row_key"], "items": elements(some["text"], memo, words)})

    texts = table.join(wanted, ["row_key", "d1", "d2"], "left_semi").select("row_key", "text")
    spelled = checkpointed(texts.mapInPandas(lambda parts: tidy(spell(parts)), "node long, items array<long>").dropDuplicates(["node"]))

    tries = members.where("node <> low").groupBy("node", "low").agg(F.count(F.lit(1)).alias("n"))
    tries = tries.groupBy("node").agg(F.min_by("low", F.struct(-F.col("n"), F.col("low"))).alias("low"))
    star = _verified(tries.select(F.col("low").alias("a"), F.col("node").alias("b")), spelled, similarity)
    group = components(star, finish_edges=0).withColumnRenamed("node", "_node")
    placed = members.join(group, members["node"] == group["_node"], "left").select("key", "node", "size", F.coalesce("comp", "node").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("key")
    rest = _linked_rest(checkpointed(placed.join(mixed, "key", "left_semi")), spelled, similarity)
    found = components(checkpointed(star.unionByName(rest)), finish_edges=0)

    named = nodes.select("d1", "d2", "node").join(found, "node", "left").select(
        "d1", "d2", F.col("node"), F.coalesce("comp", "node").alias("class_id"))
    out = signed.select("doc_id", "row_key", "d1", "d2").join(named, ["d1", "d2"])
    return out.select("doc_id", "row_key", "d1", "d2", "class_id", (F.col("row_key") == F.col("class_id")).alias("kept"))


def _linked_rest(placed: DataFrame, spelled: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between texts of one bucket that are in different components; ``placed``: key, node, size, comp.

    Texts that buckets join, by whatever way, form a unit; small units share one. A unit's texts are dealt by hash into
    blocks of about BLOCK_NODES, and every pair of blocks is a task. A text travels once per block of its unit, not once
    per pair, and a task returns a spanning forest of the links it finds.
    """
    texts = checkpointed(placed.groupBy("node").agg(F.first("size").alias("size"), F.first("comp").alias("comp"), F.collect_list("key").alias("keys")))
    lows = placed.groupBy("key").agg(F.min("node").alias("a"))
    unit = components(placed.join(lows, "key").select("a", F.col("node").alias("b")).where("a <> b"), finish_edges=0)
    unit = checkpointed(unit.withColumnRenamed("comp", "unit"))
    counts = unit.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    small = counts.where(F.col("n") <= BLOCK_NODES).agg(F.sum("n")).first()[0] or 0
    packs = max(1, -(-small // BLOCK_NODES))
    counts = counts.select("unit", F.ceil(F.col("n") / BLOCK_NODES).cast("int").alias("blocks"))
    rows = texts.join(unit, "node").join(counts, "unit").join(spelled, "node")
    shared = F.when(F.col("blocks") > 1, F.col("unit")).otherwise(-1 - F.pmod(F.xxhash64("unit"), F.lit(packs)))
    rows = rows.select(shared.alias("unit"), F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), "blocks", "node", "size", "comp", "keys", "items")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("unit", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "size", "comp", "keys", "items")

    def meet(key, part):
        return links_between(part, key[1] == key[2], similarity)

    return checkpointed(rows.groupBy("unit", "i", "j").applyInPandas(meet, "a long, b long"))


def links_between(part: pd.DataFrame, same: bool, similarity: float) -> pd.DataFrame:
    """Links of texts that share a key, are in different components and, unless ``same``, in different blocks."""
    node, size, block = part["node"].to_numpy(), part["size"].to_numpy(), part["block"].to_numpy()
    _, root = np.unique(part["comp"].to_numpy(), return_inverse=True)
    lengths = np.array([len(x) for x in part["items"]])
    _, item = np.unique(np.concatenate(part["items"].to_list()), return_inverse=True)
    ends = np.cumsum(lengths)
    buckets: dict[int, list[int]] = {}
    for k, keys in enumerate(part["keys"]):
        for key in keys:
            buckets.setdefault(key, []).append(k)
    buckets = {key: np.array(at) for key, at in buckets.items() if len(at) > 1}
    mine, out = np.zeros(int(item.max()) + 1 if len(item) else 1, bool), []
    for k, keys in enumerate(part["keys"]):
        near = [buckets[key] for key in keys if key in buckets]
        if not near:
            continue
        near = np.unique(np.concatenate(near))
        near = near[(near > k) & (root[near] != root[k]) & (np.minimum(size[near], size[k]) >= similarity * np.maximum(size[near], size[k]))]
        if not same:
            near = near[block[near] != block[k]]
        if not len(near):
            continue
        own = item[ends[k] - lengths[k]:ends[k]]
        mine[own] = True
        stops = np.cumsum(lengths[near])
        flat = np.repeat(ends[near] - stops, lengths[near]) + np.arange(stops[-1])
        shared = np.add.reduceat(mine[item[flat]].astype(np.int64), stops - lengths[near])
        mine[own] = False
        for other in near[shared >= similarity * (lengths[near] + lengths[k] - shared)]:
            if root[other] != root[k]:
                out.append((node[k], node[other]))
                root[root == root[other]] = root[k]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _verified(pairs: DataFrame, spelled: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multiset Jaccard similarity reaches the threshold."""
    left = spelled.select(F.col("node").alias("a"), F.col("items").alias("items_a"))
    right = spelled.select(F.col("node").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - shared
    return checkpointed(both.where(shared >= F.lit(similarity) * union).select("a", "b"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class left; all columns stay."""
    found = near_duplicates(docs, id_col, text_col, **options).where("kept").select("row_key", "d1", "d2").distinct()
    key = row_key(f"`{id_col}`", f"`{text_col}`").alias("row_key")
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key, *_digest(F.col(f"`{text_col}`").cast("string")))
    kept = marked.join(found, ["row_key", "d1", "d2"], "left_semi").dropDuplicates(["row_key", "d1", "d2"])
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

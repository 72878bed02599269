import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tablelearn.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i:i + 8])) for i in range(0, len(low), 8)])
    return levels


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted results."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = climb([leaf(r) for r in groups[g]])
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node, proof = leaf((*r[:4], text)), []
            for levels, at in ((trees[g], i), (top, k)):
                for level in levels[:-1]:
                    start = at // 8 * 8
                    left, right = level[start:at], level[at + 1:start + 8]
                    proof += left + right
                    node, at = sha("".join(left) + node + "".join(right)), at // 8
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], sha("".join(proof)), node, node == top[-1][0]))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(sizes, seed=1):
    rng, rows, at = random.Random(seed), [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            at += 1
            text = rng.choice(["", None, "Ab c", "ÄÖ straße Z", "x" * 50, "LONG " * 3000])
            rows.append((at, rng.choice(["web", None, ""]), lang, rng.choice([None, 5]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 8, "de": 9}, {"en": 64, "de": 65, None: 1, "": 2}, {"en": 512, "fr": 513}, {"zh": 1100, **{f"l{i}": 1 for i in range(10)}},
])
def test_manifest_equals_brute_force(spark, sizes):
    rows = rows_of(sizes)
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), claim=merkle.tampered_leaf()).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert {r.verified for r in got} <= {True, False} and any(r.verified for r in got)


def test_manifest_takes_null_and_repeated_ids(spark):
    rows = [(None, "a", "en", 1, "A"), (None, "a", "en", 1, "A"), (None, None, None, None, None), (3, "a", "en", 1, "B"), (3, "a", "en", 1, "A")] + [(7, "s", "en", 2, "Same")] * 30
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), claim=merkle.tampered_leaf()).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_manifest_empty_and_clashing_columns(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = rows_of({"en": 20, None: 3})
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("g", "node", "salt", "load", "pos", "total", "items", "root", "path", "claim", "slice"):
        frame = frame.withColumn(name, F.lit("other"))
    got = merkle.manifest(frame, claim=merkle.tampered_leaf()).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_paths_lead_from_leaf_to_root(spark):
    got = merkle.manifest(spark.createDataFrame(rows_of({"en": 70, "de": 3}), SCHEMA), paths=True).collect()
    for r in got:
        node = r.leaf
        for step in r.path:
            node = sha(step.l + node + step.r)
        assert node == r.root == r.folded_root and r.verified

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tablelearn.llm import decontaminate
from tablelearn.llm.queries import op12_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for i, text in items:
        ws = words(text)
        n = min(window, len(ws))
        for p in range(len(ws) - n + 1 if n else 0):
            windows.setdefault(tuple(ws[p:p + n]), set()).add(i)
    out, sizes = [], {len(w) for w in windows}
    for d, text in docs:
        ws, hit, ids = words(text), set(), set()
        for n in sizes:
            for p in range(len(ws) - n + 1):
                owners = windows.get(tuple(ws[p:p + n]))
                if owners is not None:
                    hit.update(range(p, p + n))
                    ids |= owners
        names = sorted(str(i) for i in ids if i is not None)
        out.append((d, len(ws), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def some(seed=3):
    rng = random.Random(seed)
    say = lambda n, k=12: " ".join(rng.choice([f"w{rng.randrange(k)}", "The", "é", "W1"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 9, 10, 11, 25]), 40)) for i in range(12)]
    items += [(50, None), (51, ""), (52, "!!!"), (None, say(14)), (53, items[6][1]), (10, "zz zz zz zz zz zz zz zz zz zz zz zz")]
    docs = [(i, say(rng.randrange(0, 60), 40)) for i in range(40)]
    for i in range(60, 100):
        item = rng.choice(items)[1] or ""
        ws = item.split()
        cut = ws[rng.randrange(0, 3):]
        docs.append((i, f"{say(rng.randrange(0, 9))}. {' -- '.join(cut).upper()}! {say(4)}"))
    docs += [(200, None), (201, ""), (202, "zz " * 30), (203, "zz " * 9), (None, items[5][1]), (None, None), (5, docs[70][1]), (300, say(30000, 40)), (301, " ".join((t or "") for _, t in items * 3))]
    docs += [(400, docs[45][1])] * 25
    return docs, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_contamination_equals_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, items = some()
    got = decontaminate.contamination(*frames(spark, docs, items)).collect()
    want = brute(docs, items)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert 20 < sum(r[5] for r in want) < len(docs)


def test_contamination_of_empty_tables_and_clashing_columns(spark):
    docs, items = some(5)
    a, b = frames(spark, docs, items)
    assert decontaminate.contamination(a.limit(0), b).count() == 0
    for nothing in (b.limit(0), b.where("text = '!!!'")):
        assert sorted((tuple(r) for r in decontaminate.contamination(a, nothing).collect()), key=repr) == brute(docs, [])
    for name in ("k1", "k2", "win", "key", "n_hit", "ids", "item_id", "ws"):
        a = a.withColumn(name, F.lit("other"))
    for name in ("doc_id", "len", "wid", "ids", "off"):
        b = b.withColumn(name, F.lit("other"))
    assert sorted((tuple(r) for r in decontaminate.contamination(a, b).collect()), key=repr) == brute(docs, items)


def test_a_window_has_ten_words(spark):
    item = "a b c d e f g h i j k l"
    docs = [(1, "a b c d e f g h i"), (2, "x A,b.c d e f g h i J"), (3, "a b c d e f g h i j k l z"), (4, "a b c d x e f g h i j k l"), (5, "ab c d e f g h i j k")]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(*frames(spark, docs, [(1, item)])).collect()}
    assert got == {1: (9, 0, 0), 2: (11, 10, 1), 3: (13, 12, 1), 4: (13, 0, 0), 5: (10, 0, 0)}


def test_plan_has_no_python(spark):
    text = op12_decontamination(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text

import random
from collections import Counter

import numpy as np
import pytest

from tablelearn.llm import bagminhash, fingerprint, substring
from tablelearn.llm.shingles import WordHash, elements, runs, shingles


def bag(text):
    words = (text or "").lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def alike(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if a and b else 0.0


def corpus(rng, many=60):
    words = [f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 6, 40, 120]))) for _ in range(many)]
    for k in range(25):  # near copies of all strengths, in chains
        base = texts[rng.randrange(len(texts))].split()
        for _ in range(rng.randint(0, max(1, len(base) // 25))):
            base[rng.randrange(len(base))] = rng.choice(words)
        texts.append(" ".join(base))
    texts += [texts[0]] * 6 + [texts[1].upper(), "  " + texts[2].replace(" ", "\n\t"), "", "", None, "one", "one", "a b c d", "a b c d e"]
    texts += ["z z z z z z z z z z z z", "z z z z z z z z z z z", "long " * 30_000]
    return texts


def test_shingles_are_multisets():
    texts = corpus(random.Random(1))
    owner, value = shingles(texts, WordHash(limit=50))
    for k, text in enumerate(texts):
        assert sorted(Counter(value[owner == k].tolist()).values()) == sorted(bag(text).values())
    items = elements(texts, WordHash())
    for a in range(0, len(texts), 7):
        for b in range(0, len(texts), 5):
            both = len(np.intersect1d(items[a], items[b]))
            assert both == sum((bag(texts[a]) & bag(texts[b])).values())


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
    b[:10] = a[:10]
    names = rng.integers(0, 2**63, 40).astype(np.uint64)
    owner = np.repeat([0, 1], 40)
    weight = np.concatenate([a, b])
    keep = weight > 0
    sign = bagminhash.signatures(owner[keep], np.concatenate([names, names])[keep], weight[keep], 2, 20_000)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sign[0] == sign[1]).mean() - truth) < 0.015


def components_of(texts, ids, similarity=0.8):
    bags = [bag(t) for t in texts]
    label = list(ids)
    links = [(i, j) for i in range(len(texts)) for j in range(i) if (alike(bags[i], bags[j]) >= similarity) or (texts[i] or "").lower() == (texts[j] or "").lower()]
    for _ in texts:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("seed", [3, 4])
def test_near_duplicates_equal_brute_force(spark, seed):
    texts = corpus(random.Random(seed))
    ids = list(range(len(texts)))
    random.Random(seed).shuffle(ids)
    frame = spark.createDataFrame([(i, t, "k", 0) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, key string, low int").repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in bagminhash.near_duplicates(frame).collect()}
    want = components_of(texts, ids)
    assert got == {i: (w, i == w) for i, w in zip(ids, want, strict=True)}
    kept = bagminhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_chains_link_through_texts_that_are_no_buckets_first(spark):
    """A group in which the least text is like only some of the others."""
    words = [f"v{k}" for k in range(400)]
    texts = []
    for k in range(30):  # each is like its neighbours, the ends are not alike
        texts.append(" ".join(words[k * 6:k * 6 + 200]))
    order = list(range(30))
    random.Random(5).shuffle(order)
    frame = spark.createDataFrame([(i, t) for i, t in zip(order, texts, strict=True)], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_duplicates(frame).collect()}
    want = components_of(texts, order)
    assert [got[i] for i in order] == want


def test_second_check_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK_NODES", 4)
    rng = random.Random(9)
    words = [f"x{k}" for k in range(500)]
    base = rng.choices(words, k=120)
    texts = []
    for k in range(60):  # a group whose members are alike with very different strength
        own = list(base)
        for _ in range(rng.randint(0, 8)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.near_duplicates(frame).collect()}
    want = components_of(texts, list(range(60)))
    assert [got[i] for i in range(60)] == want and len(set(want)) > 3


def test_near_duplicates_without_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (None, "other words in here now"), (9, None), (9, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = bagminhash.near_duplicates(frame).collect()
    assert len(got) == 6 and all(r["class_id"] == 7 for r in got if r["doc_id"] in (None, 7) and r["class_id"] < 100 and r["doc_id"] != 9)
    kept = bagminhash.drop_near_duplicates(frame).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == [(0, "other words in here now"), (7, "a b c d e f"), (9, "")]
    assert bagminhash.near_duplicates(frame.limit(0)).count() == 0 and bagminhash.drop_near_duplicates(frame.limit(0)).count() == 0


def plain_units(text):
    """(start, end, words) by one character after another."""
    out, at, begin, last, words, line = [], 0, None, None, [], True
    while at < len(text):
        if text[at].isspace():
            line = line or text[at] == "\n"
            at += 1
            continue
        end = at
        while end < len(text) and not text[end].isspace():
            end += 1
        ch = text[at]
        upper = "A" <= ch <= "Z" or ("À" <= ch <= "Þ" and ch != "×")
        if begin is None or line or upper or text[last - 1] in ".!?…":
            if begin is not None:
                out.append((begin, last, words))
            begin, words = at, []
        words.append("".join(c.lower() if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in text[at:end]))
        last, at, line = end, end, False
    if begin is not None:
        out.append((begin, last, words))
    return out


def test_units_equal_a_plain_reading():
    rng = random.Random(6)
    for _ in range(400):
        text = "".join(rng.choice("abAÉé×.!?… \n\t  ,🙂") for _ in range(rng.randint(0, 80)))
        start, end, words, digest = substring.units(text)
        want = plain_units(text)
        assert [(a, b, len(w)) for a, b, w in want] == list(zip(start.tolist(), end.tolist(), words.tolist(), strict=True))
        for i, (_, _, w) in enumerate(want):
            for j, (_, _, v) in enumerate(want):
                assert (w == v) == (digest[i] == digest[j])


def plain_removal(rows, min_words=8):
    """What a reading of all rows in order of id removes."""
    seen, out = {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        units, flags, here = plain_units(text or ""), [], set()
        for _, _, words in units:
            key = tuple(words)
            flags.append(key in here or seen.get(key, i) != i)
            here.add(key)
        for key in here:
            seen.setdefault(key, i)
        spans, at = [], 0
        while at < len(units):
            stop = at
            while stop < len(units) and flags[stop]:
                stop += 1
            if stop > at and sum(len(u[2]) for u in units[at:stop]) >= min_words:
                spans.append((units[at][0], units[stop - 1][1]))
            at = max(stop, at + 1)
        out.append((i, spans))
    return out


def test_remove_repeats_equals_a_plain_reading(spark):
    rng = random.Random(7)
    pool = [" ".join(rng.choices(["ab", "cd", "Ef", "gh", "ij."], k=rng.randint(1, 14))).capitalize() + "." for _ in range(60)]
    passage = "The quick passage of many words. " * 1 + " ".join(f"p{k}" for k in range(55)) + ". And it ends here, at last."
    rows = [(i, rng.choice([" ", "\n", "\n\n", "  "]).join(rng.choices(pool, k=rng.randint(1, 9)))) for i in range(50)]
    rows += [(60, "unlike before " + passage + " after it"), (61, "x y z " + passage), (62, passage + " tail"), (63, None), (64, ""), (65, "   "),
             (66, "Same old line with more than eight words in it.\n" * 5), (67, " ".join(f"u{k}" for k in range(20_000)))]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, digest int, first string").repartition(4)
    got = {r["doc_id"]: r for r in substring.remove_repeats(frame).collect()}
    assert len(got) == len(rows)
    texts = dict(rows)
    for i, spans in plain_removal(rows):
        assert [(s["start"], s["end"]) for s in got[i]["removed"]] == spans
        assert got[i]["n_removed"] == sum(b - a for a, b in spans)
        if texts[i] is None:
            assert got[i]["text"] is None
        else:
            solid = "".join("".join(c for k, c in enumerate(texts[i]) if not any(a <= k < b for a, b in spans)).split())
            assert "".join(got[i]["text"].split()) == solid
    assert "p7" in got[60]["text"] and "p7" not in got[61]["text"] and "p7" not in got[62]["text"] and got[61]["text"].split() == ["x", "y", "z"]
    cut = substring.drop_repeats(frame)
    assert cut.columns == frame.columns and {r["doc_id"]: r["text"] for r in cut.collect()} == {i: r["text"] for i, r in got.items()}


def test_remove_repeats_without_ids(spark):
    line = "This one line is surely long enough to count."
    rows = [(None, line + "\nmine"), (5, line), (5, line), (None, None)]
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in got) == [("5", line), ("5", line), ("None", "None"), ("None", "mine")]
    assert substring.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def weights(text):
    return Counter({w: n * len(w) for w, n in Counter(text.split()).items()})


def test_fingerprints(spark):
    import hashlib

    rng = random.Random(8)
    rows = [(k * 3, " ".join(rng.choices([f"t{j}" * (1 + j % 3) for j in range(40)], k=rng.randint(5, 90)))) for k in range(40)]
    rows += [(200, None), (201, ""), (202, "   "), (203, "ä"), (204, rows[0][1]), (205, rows[0][1]), (206, "w" * 50_000), (207, "🙂 é " * 9)]
    frame = spark.createDataFrame([(*r, "b", 1) for r in rows], "doc_id long, text string, bucket string, place int").repartition(6)
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(frame, bucket_rows=8).collect()}
    assert len(got) == len(rows)
    misses = []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(got[i]["fingerprint"]) == 4 * fingerprint.SAMPLES
        for name, other in (("near_edited", edited), ("near_next", after)):
            a, b = weights(text), weights(other)
            truth = alike(a, b) if a or b else 1.0
            misses.append(got[i][name] - truth)
            assert abs(got[i][name] - truth) < 0.3 and (truth not in (0.0, 1.0) or got[i][name] == pytest.approx(truth, abs=0.001))
    assert abs(np.mean(misses)) < 0.02
    assert got[0]["fingerprint"] == got[204]["fingerprint"] == got[205]["fingerprint"] and got[200]["fingerprint"] == "f" * 256
    whole = {i: r["fingerprint"] for i, r in got.items()}
    assert whole == {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(frame.repartition(3)).collect()}


def test_fingerprints_of_few_rows(spark):
    one = fingerprint.fingerprints(spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    rows = [(None, "last one"), (3, "b b"), (3, "a a"), (3, "a a"), (-10**15, "far off"), (None, None)]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6 and sorted(r["near_next"] for r in got if r["doc_id"] == 3) == [0.0, 0.0, 1.0]
    assert fingerprint.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs():
    owner, value = np.array([0, 0, 0, 1, 1]), np.array([5, 5, 6, 6, 6])
    first, length = runs(owner, value)
    assert first.tolist() == [0, 2, 3] and length.tolist() == [2, 1, 2]


def plain_passages(rows, min_words=8, passage=50):
    """What goes by a reading of all rows in order of id, with sequences of words as they are."""
    seen, out = {}, []
    for i, text in rows:
        begin, end, _, first = substring.tokens(text)
        words = [text[a:b].lower() for a, b in zip(begin, end, strict=True)]
        head = [k for k, f in enumerate(first) if f] + [len(words)]
        ranges = {(k, k + passage) for k in range(len(words) - passage + 1)}
        for k, a in enumerate(head[:-1]):
            ranges.update([(a, b) for b in head[k + 1:] if b - a >= min_words][:1])
            ranges.update([(c, head[k + 1]) for c in head[k::-1] if head[k + 1] - c >= min_words][:1])
        gone, here = set(), {}
        for a, b in sorted(ranges):
            key = tuple(words[a:b])
            if seen.get(key, i) != i or here.setdefault(key, b) <= a:
                gone.update(range(a, b))
        for key in here:
            seen.setdefault(key, i)
        for key in (tuple(words[a:b]) for a, b in ranges):
            seen.setdefault(key, i)
        out.append((i, [w for k, w in enumerate(words) if k not in gone]))
    return out


def kept_words(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r["doc_id"]: r["text"] for r in substring.remove_passages(frame).collect()}


def test_remove_passages_equals_a_plain_reading(spark):
    rng = random.Random(8)
    pool = [" ".join(rng.choices(["ab", "cd", "Ef", "gh", "ij."], k=rng.randint(1, 14))).capitalize() + "." for _ in range(60)]
    texts = [rng.choice([" ", "\n"]).join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(60)]
    prose = " ".join(f"p{rng.randrange(40)}" for _ in range(400)).split()
    for _ in range(60):
        at = rng.randrange(300)
        texts.append(" ".join([*rng.choices(prose, k=rng.randint(0, 9)), *prose[at:at + rng.randint(40, 100)], *rng.choices(prose, k=rng.randint(0, 9))]))
    texts += ["long " * 300, "Ha ha\n" * 20, "on and on " * 60, "", "one"]
    rows = list(enumerate(texts))
    got = kept_words(spark, rows)
    for i, words in plain_passages(rows):
        assert got[i].lower().split() == words


def test_units_of_unrelated_documents_do_not_add_up(spark):
    names = [f"Name{k}" for k in range(12)]
    rows = [(k, f"{n}\nonly here {k}") for k, n in enumerate(names)] + [(50, " ".join(names)), (51, "NEW TITLE"), (52, " ".join(names))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = kept_words(spark, rows)
    assert got[50] == " ".join(names) and got[52] == "" and all(got[k] == t for k, t in rows[:12])


def test_passages_inside_lines_and_other_scripts(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    chinese = "".join(chr(0x4E00 + 7 * k) for k in range(60))
    rows = [(1, f"starts low {passage} goes on"), (2, f"other words {passage} and more"), (3, f"cut {passage[:150]} short"),
            (4, "甲" + chinese + "乙"), (5, "丙丁" + chinese + "戊"), (6, "一二三四五六七八九十。新的内容"), (7, "旧的内容。一二三四五六七八九十。")]
    got = kept_words(spark, rows)
    assert got[1] == rows[0][1] and got[2] == "other words and more" and got[3] == rows[2][1]
    assert got[4] == rows[3][1] and got[5] == "丙丁戊" and got[6] == rows[5][1] and got[7] == "旧的内容。"

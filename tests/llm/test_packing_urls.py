import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tablelearn.llm import packing, urls


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.tokenizer_path())


def test_encoder_equals_the_tokenizer(tokenizer):
    texts = ["", " ", "  a  b ", "a\n \nb", "don't  stop\t\tit's", "x\u00a0y  z", "a\u2003 b", "a\x1c b", "<|endoftext|> tail", "é" * 500, "日本 語です",
             "12 345,6 !!  ??\n\n\n", "\u200b x", "trailing \n ", "w" * 3000, "🙂 🙂🙂"]
    rng = random.Random(1)
    texts += ["".join(rng.choice("ab '.!1\n\t é\u00a0") for _ in range(60)) for _ in range(300)]
    encode = packing.Encoder(packing.tokenizer_path(), memo=50)
    want = [np.asarray(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encode(texts) == want and encode(texts) == want


def test_best_fit_is_the_tightest_window():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 40) for _ in range(400)), reverse=True)
    where, offset = packing.best_fit(lengths, 40)
    left, plain = [], []
    for need in lengths:  # plain search of all windows
        fits = [(room, k) for k, room in enumerate(left) if room >= need]
        plain.append(min(fits)[0] if fits else 40)
        if fits:
            left[min(fits)[1]] -= need
        else:
            left.append(40 - need)
    assert [40 - o for o in offset] == plain  # the same remaining capacity each time
    assert len(set(where)) == len(left)


def test_pack_documents(spark, tokenizer):
    rows = [(1, "one two three", "x"), (2, None, "y"), (3, "", "z"), (None, "no id", None), (4, "word " * 9000, "q"), (1, "one two three", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string").withColumnRenamed("sequence_id", "offset")
    got = [r.asDict() for r in packing.pack_documents(docs, window=64, group_docs=2, with_ids=True).collect()]
    by = {}
    for r in got:
        by.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    want = sorted(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    assert sorted(r["doc_tokens"] for r in got if r["start"] == 0) == want
    for r in got:
        assert 0 < r["length"] <= 64 and r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<i4").tobytes()) and len(r["ids"]) == r["length"]
    assert sum(r["length"] for r in got) == sum(want)
    for _, part in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in part:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    long = [r for r in got if r["doc_id"] == 4]
    ids = [i for r in sorted(long, key=lambda r: r["start"]) for i in r["ids"]]
    assert ids == [*tokenizer.encode("word " * 9000, add_special_tokens=False).ids, 1]


def test_sequences_pad_except_at_powers_of_two(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g h")], "doc_id long, text string")
    got = packing.sequences(packing.pack_documents(docs, window=10, with_ids=True), window=10).collect()
    assert sorted((r["n_tokens"], len(r["input_ids"])) for r in got) == [(8, 8), (9, 10)]


def test_pack_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_urls(spark):
    cases = [
        ("http://A.Example.ORG/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("http://example.org/en/12?x", "example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://org/", "org", "/", "org/", "allow"), ("http://borg/", "borg", "/", None, "allow"),
        ("https://x.com/fr/adult", "x.com", "/fr/adult", "com/fr/", "allow"), ("https://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("https://x.com/de", "x.com", "/de", None, "allow"), ("https://x.org", "x.org", "", None, "allow"),
        ("https://adult-x.net/", "adult-x.net", "/", None, "block"), ("https://adults.net/sussex", "adults.net", "/sussex", None, "allow"),
        ("https://free-bets.net/a#b://c", "free-bets.net", "/a", None, "block"), ("https://free.net/free/FREE", "free.net", "/free/FREE", None, "allow"),
        ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"), ("x://?q", "", "", None, "allow"),
        ("a://É.org/Ä\n?", "É.org", "/Ä\n", "org/", "allow"), ("http://n.net/" + "a" * 100_000 + "-xxx", "n.net", "/" + "a" * 100_000 + "-xxx", None, "block"),
    ]
    pages = spark.createDataFrame([(k, c[0], "h") for k, c in enumerate(cases)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.judge_urls(pages).collect()}
    for k, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) == (host, path, rule, verdict), cases[k][0][:80]
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_vocabulary_equals_regular_expressions():
    rng, count = random.Random(3), urls.vocabulary(urls.STRICT, urls.SOFT)
    parts = [*urls.STRICT, *urls.SOFT, "-", "/", ".", "a", "9", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        found = {t: len(re.findall(f"(?<![a-z0-9])(?={re.escape(t)}(?![a-z0-9]))", text)) for t in {*urls.STRICT, *urls.SOFT}}
        assert count(text) == (sum(found[t] for t in urls.STRICT), sum(found[t] > 0 for t in urls.SOFT))

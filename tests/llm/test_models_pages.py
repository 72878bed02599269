import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablelearn.llm import hmm, sitetree, toxicity


def test_forward_recursion_equals_the_sum_over_all_paths():
    rng = np.random.default_rng(1)
    model = hmm.Model(rng.dirichlet([1] * 3), rng.dirichlet([1] * 3, 3), rng.dirichlet([1] * 5, 3).T)
    sequences = [rng.integers(0, 5, n) for n in (1, 2, 6, 4, 6, 1)]
    for sequence, got in zip(sequences, hmm.log_likelihood(model, sequences), strict=True):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(sequence)):
            p = model.start[path[0]] * model.emit[sequence[0], path[0]]
            for t in range(1, len(sequence)):
                p *= model.move[path[t - 1], path[t]] * model.emit[sequence[t], path[t]]
            total += p
        assert got == pytest.approx(math.log10(total))


def test_expected_counts_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(2)
    model = hmm.Model(rng.dirichlet([1] * 2), rng.dirichlet([1] * 2, 2), rng.dirichlet([1] * 4, 2).T)
    sequences = [rng.integers(0, 4, n) for n in (5, 1, 3, 5)]
    opens = [True, False, True, False]
    starts, moves, emits = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for sequence, first in zip(sequences, opens, strict=True):
        weights = {}
        for path in itertools.product(range(2), repeat=len(sequence)):
            p = model.start[path[0]] * model.emit[sequence[0], path[0]]
            for t in range(1, len(sequence)):
                p *= model.move[path[t - 1], path[t]] * model.emit[sequence[t], path[t]]
            weights[path] = p
        total = sum(weights.values())
        for path, p in weights.items():
            starts[path[0]] += first * p / total
            for t, s in enumerate(path):
                emits[sequence[t], s] += p / total
                if t:
                    moves[path[t - 1], s] += p / total
    got = hmm.expected_counts(model, sequences, opens)
    for a, b in zip(got, (starts, moves, emits), strict=True):
        assert np.allclose(a, b)


def words(text):
    return (text or "").encode().lower().split()


def corpus(rng, many=300):
    """Two kinds of documents with words of their own."""
    kinds = [[f"a{k}" for k in range(60)], [f"Ö{k}" for k in range(60)]]
    rows = []
    for i in range(many):
        own = kinds[i % 3 == 0]
        rows.append((i, " ".join(rng.choices(own + ["the", "."], k=rng.randint(5, 60)))))
    return rows


def test_score_texts(spark):
    rng = random.Random(3)
    rows = corpus(rng) + [(1000, None), (1001, ""), (1002, "unseen words only, here"), (None, "a1 a2 a3"), (2000, "a1 the"), (2000, "a1 the"), (1003, "w " * 40_000)]
    frame = spark.createDataFrame([(*r, 1, "t") for r in rows], "doc_id long, text string, row long, tokens string").repartition(5)
    got = hmm.score_texts(frame, common=40, states=3, rounds=3).collect()
    counts, total = Counter(), 0
    for i, text in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words(text))
            counts[None] += 1
            total += len(words(text)) + 1
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], r)
    for i, text in rows:
        r, tokens = by[i], [*words(text), None]
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 7 == 2)
        assert r["n_tokens"] == len(tokens) and r["train_tokens"] == total and r["n_known"] == sum(counts[t] > 0 for t in tokens)
        base = sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens)
        assert r["base_score"] == pytest.approx(base, abs=1e-6 * len(tokens)) and r["score"] < 0
    held = [r for r in got if r["held_out"] and r["doc_id"] < 1000]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert hmm.score_texts(frame.limit(0)).count() == 0


def test_scores_do_not_depend_on_the_layout(spark):
    rows = corpus(random.Random(8), 400)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    many = frame.orderBy(F.desc("doc_id")).repartition(7)
    one, other = ({r["doc_id"]: r["score"] for r in hmm.score_texts(f.coalesce(n), common=50, states=4).collect()} for f, n in ((frame, 1), (many, 7)))
    assert one.keys() == other.keys() and all(one[i] == pytest.approx(other[i], rel=1e-6) for i in one)


def test_first_guess_equals_hard_assignment_of_all_windows(spark):
    rng, states = np.random.default_rng(9), 4
    vocabulary = hmm.Vocabulary(np.arange(1, 31), rng.integers(1, 50, 30).astype(float), np.ones(hmm.CLASSES), 12, 900, 31)
    documents = [rng.choice(vocabulary.symbols, n, p=vocabulary.shared()) for n in (1, 5, hmm.WINDOW_TOKENS, hmm.WINDOW_TOKENS + 1, 4 * hmm.WINDOW_TOKENS + 7, 300, 300, 90)]
    training = spark.createDataFrame([(d.tolist(),) for d in documents], "tokens array<int>").repartition(3)
    planes = hmm.directions(vocabulary, states)
    assert np.allclose(vocabulary.shared() @ planes, 0) and planes.shape[1] == 2
    windows = [d[k:k + hmm.WINDOW_TOKENS] for d in documents for k in range(0, len(d), hmm.WINDOW_TOKENS)]
    own = [sum(int(sum(planes[t, b] for t in w) > 0) << b for b in range(2)) for w in windows]
    for rounds in range(3):
        emits = np.zeros((vocabulary.symbols, states))
        for w, state in zip(windows, own, strict=True):
            for t in w:
                emits[t, state] += 1
        want = (emits + hmm.SMOOTHING * vocabulary.shared()[:, None]) / (emits.sum(axis=0) + hmm.SMOOTHING)
        assert np.allclose(hmm.first_guess(training, vocabulary, states, rounds).emit, want)
        own = [max(range(states), key=lambda c: sum(math.log(want[t, c]) for t in w)) for w in windows]


def test_model_is_a_distribution_over_words(spark):
    """The probabilities of all known words and of one unknown word per class add up to one."""
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"v{k}" for k in range(80)], k=30)) for _ in range(40)]
    counts = hmm.count_words(spark.createDataFrame([(t,) for t in texts], "text string"))
    vocabulary, rare = hmm.read_vocabulary(counts, common=20)
    shared = vocabulary.shared()
    assert shared.sum() == pytest.approx(1)
    mass = np.ones(hmm.CLASSES)
    for r in rare.collect():
        mass[r["class"]] += r["n"] + 1
    assert np.array_equal(mass, vocabulary.mass)
    seen = Counter(w for t in texts for w in words(t))
    assert vocabulary.tokens == sum(seen.values()) + len(texts) and vocabulary.words == len(seen) + 1


ARTICLE = """<!DOCTYPE html><html><head><title>t</title><style>p > b{}</style><script>var a="</p><article>x</article>";if(a<b){}</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Menu</li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><aside>Side</aside>
<article class="post"><header><h1>The&nbsp;title &amp; more</h1></header><p>First   <b>bold</b> &lt;tag&gt;<br>line<p>Second &#8364;
para<div class="adBox ad">Buy</div><ul><li>One<li>Two</ul><form><p>Mail</p><input></form><table><tr><td>c1<td>c2</table>
<pre>  pre
 text</pre><p hidden>gone</p><p style="display: none">gone</p><p data-x='a>b' title="c > d">Kept</p><section id="comments"><p>Nice!</p></section></article>
<footer>Foot</footer></body></html>"""
WANT = "The title & more\n\nFirst bold <tag> line\n\nSecond € para\n\nOne\n\nTwo\n\nc1\n\nc2\n\npre text\n\nKept"


def test_main_text(spark):
    rows = [(1, "http://a.org/1", ARTICLE), (2, None, None), (3, "http://a.org/3", ""), (4, "x", "plain text\nhere"), (None, "http://a.org/1", ARTICLE),
            (5, "http://b.org", "<p>unclosed <i>tag & &copy; <a href='x'>link</a> 1 < 2 <"), (6, "http://b.org", "<div id=main><p>" + "long " * 50_000),
            (7, "http://b.org", "<main><p>a</p><article class=comment>c</article></main>"), (8, "http://b.org", "<p " + "\"" * 3000 + "x<p>y")]
    pages = spark.createDataFrame([(*r, "h", 0) for r in rows], "page_id long, url string, html string, host string, mark int")
    got = sorted(sitetree.main_text(pages).collect(), key=lambda r: (r["page_id"] is None, r["page_id"]))
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and text[1] == WANT and text[None] == WANT
    assert text[2] == "" and text[3] == "" and text[4] == "plain text here"
    assert text[5] == "unclosed tag & © link 1 < 2 <" and text[6] == "long " * 49_999 + "long" and text[7] == "a" and "y" in text[8]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert sitetree.main_text(pages.limit(0)).count() == 0


def test_style_tree_removes_what_all_pages_share(spark):
    """Boxes that no name gives away: the same text on every page, next to content that differs."""
    rows = []
    for k in range(12):
        body = f"<div class=x1><p>Follow us on everything</p></div><div class=x2><p>Story {k} begins</p><p>and ends {k}</p></div><div class=x3>All rights</div>"
        rows.append((k, "http://a.org/", f"<html><body>{body}</body></html>"))
    rows += [(100 + k, "http://b.org/", "<html><body><div class=x1><p>Same copy</p></div></body></html>") for k in range(12)]  # copies count once
    rows += [(200 + k, "http://c.org/", f"<article><p>Repeated first line</p><p>Text {k}</p></article>") for k in range(12)]
    got = {r["page_id"]: r["text"] for r in sitetree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    for k in range(12):
        assert got[k] == f"Story {k} begins\n\nand ends {k}"
        assert got[100 + k] == "Same copy"
        assert got[200 + k] == f"Repeated first line\n\nText {k}"


def test_style_tree_judges_single_texts_and_small_hosts(spark):
    rows = []
    for k in range(20):  # a line in a plain paragraph of the article, on all pages
        rows.append((k, "http://a.org/", f"<article><h2>Report</h2><p>The report of day {k} with its news</p><p>Sign up for our letter</p><ul><li>Yes</li></ul></article>"))
    for k in range(5):  # a box that no name gives away, on all five pages
        rows.append((100 + k, "http://b.org/", f"<div><div class=x1>Made with care in town</div><div class=x2>Page {k}, different from {k + 1}</div></div>"))
    for k in range(3):  # three pages prove nothing
        rows.append((200 + k, "http://c.org/", f"<div><div class=x1>Same</div><div class=x2>Page {k}</div></div>"))
    for k in range(9):  # one article in many editions
        rows.append((300 + k, "http://d.org/", f"<article><p>All of this article stands on every page</p><p>Edition {k}</p></article>"))
    got = {r["page_id"]: r["text"] for r in sitetree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert all(got[k] == f"Report\n\nThe report of day {k} with its news\n\nYes" for k in range(20))
    assert all(got[100 + k] == f"Page {k}, different from {k + 1}" for k in range(5))
    assert all(got[200 + k] == f"Same\n\nPage {k}" for k in range(3))
    assert all(got[300 + k] == f"All of this article stands on every page\n\nEdition {k}" for k in range(9))


def tree_by_definition(pages, least=sitetree.MIN_IMPORTANCE):
    """The style tree of one host's pages in plain Python."""
    once, kept = {tuple(p["texts"]): p for p in sorted(pages, key=lambda p: -p["form"])}.values(), []
    have, shapes, texts = Counter(), {}, {}
    for p in once:
        for s in p["shapes"]:
            have[s["branch"]] += 1
            shapes.setdefault(s["branch"], Counter())[s["shape"]] += 1
        for branch, text in {(x, t) for t, b in zip(p["texts"], p["branches"], strict=True) for x in b}:
            texts.setdefault(branch, Counter())[text] += 1

    def low(branch):
        m = have[branch]
        if m < 2:
            return False
        counts = texts[branch].values()
        content = 1 - sum(n * math.log(n) for n in counts) / sum(counts) / math.log(m)
        shape = -sum(n / m * math.log(n / m) for n in shapes[branch].values()) / math.log(m)
        keep = sitetree.DECAY ** (min(len(shapes[branch]), 10) - 1)
        return 1 - (1 - keep * content - (1 - keep) * min(shape, 1)) * math.log(m) / math.log(m + 1) < least

    def single(branch, text):
        return have[branch] > 1 and texts[branch][text] > 0 and 1 - math.log(texts[branch][text]) / math.log(have[branch] + 1) < least

    for p in pages:
        blocks = list(zip(p["texts"], p["free"], p["part"], p["branches"], strict=True))
        left = [b for b in blocks if b[1] or not any(low(x) for x in b[3])]
        rest = [b for b in left if b[2] or not single(b[3][-1], b[0])]
        if 2 * sum(len(b[0]) for b in rest) < sum(len(b[0]) for b in left):
            rest = left
        kept.append("\n\n".join(b[0] for b in (rest or blocks)))
    return kept


@pytest.mark.parametrize("limit", [20_000, 0])
def test_style_tree_equals_the_definition(spark, monkeypatch, limit):
    monkeypatch.setattr(sitetree, "BROADCAST_BRANCHES", limit)
    rng, rows = random.Random(11), []
    for host, many in enumerate((1, 2, 3, 4, 5, 6, 7, 12, 40)):
        shared = [f"shared {host} {k}" for k in range(4)]
        for _ in range(many):
            html = f"<p>{shared[0]}</p>" * (rng.random() < 0.95) + f"<div class=d>{shared[1]}</div>" * (rng.random() < 0.95)
            for _ in range(rng.randint(1, 7)):
                text = rng.choice(shared) if rng.random() < 0.2 else f"own text {rng.random()}"
                html += f"<{(tag := rng.choice(['p', 'div class=a', 'div class=b', 'h2', 'section id=c']))}>{text}</{tag.split()[0]}>"
            rows.append((len(rows), f"http://h{host}.org/", f"<article>{html}</article>" if rng.random() < 0.6 else f"<body>{html}</body>"))
    rows += [(len(rows) + k, url, html) for k, (_, url, html) in enumerate(rng.choices(rows, k=10))]
    got = {r["page_id"]: r["text"] for r in sitetree.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    hosts, changed = {}, 0
    for i, url, html in rows:
        hosts.setdefault(url, []).append((i, sitetree._read(html)))
    for pages in hosts.values():
        for (i, page), want in zip(pages, tree_by_definition([p for _, p in pages]), strict=True):
            assert got[i] == want
            changed += want != "\n\n".join(page["texts"])
    assert changed > 20


def test_names_drop_no_article():
    body = "<p>Long text of the article</p><p>and its end</p>"
    for name in ("content no-sidebar", "has-comments", "with-sidebar", "social-layout"):
        page = f"<body><div class='{name}'><div class=sidebar><article>Teaser</article>Links</div><article>{body}</article></div><div class=widget>Buy</div></body>"
        assert sitetree._read(page)["texts"] == ["Long text of the article", "and its end"]
        assert sitetree._read(f"<body><div class='{name}'>{body}</div><p>Short</p></body>")["texts"] == ["Long text of the article", "and its end", "Short"]
    assert sitetree._read("<div class=widget>a</div><div class=popup>b</div>")["texts"] == ["a", "b"]
    page = f"<article>{body}</article><div id=comments><article>{'much more of a comment ' * 20}</article></div>"
    assert sitetree._read(page)["texts"] == ["Long text of the article", "and its end"]


def test_importance_equals_entropy(spark):
    rng = random.Random(5)
    pages = 9
    texts = [set(rng.sample(range(6), 3)) for _ in range(pages)]
    shapes = [rng.randrange(3) for _ in range(pages)]
    rows = [("h", 1, 2, 0, pages)]
    rows += [("h", 1, 0, f, sum(f in t for t in texts)) for f in range(6) if any(f in t for t in texts)]
    rows += [("h", 1, 1, s, shapes.count(s)) for s in set(shapes)]
    frame = spark.createDataFrame([(a, b, c, d, e) for a, b, c, d, e in rows], "host string, branch long, kind int, feature long, pages long")
    got = sitetree.importance(frame).first()["importance"]
    entropies = [math.log(sum(f in t for t in texts)) / math.log(pages) for t in texts for f in t]
    shape = -sum(n / pages * math.log(n / pages) for n in Counter(shapes).values()) / math.log(pages)
    keep = sitetree.DECAY ** (len(set(shapes)) - 1)
    assert got == pytest.approx(keep * (1 - sum(entropies) / len(entropies)) + (1 - keep) * shape)


def toxic_corpus(rng, many=1500):
    """Clean prose, and documents with abuse: known words, and a stem that only the labels give away."""
    plain = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re") for b in ("la", "no", "si", "du", "pe", "gra")]
    rows, labels = [], []
    for i in range(many):
        text = rng.choices(plain, k=rng.randint(8, 80))
        toxic = int(rng.random() < 0.15)
        if toxic:
            for _ in range(rng.randint(1, 5)):
                text[rng.randrange(len(text))] = rng.choice(["idiot", "Moron,", "worthless"]) if i % 2 else "zux" + rng.choice(plain)
        rows.append((i, " ".join(text)))
        if rng.random() < 0.7:
            labels.append((i, toxic))
    return rows, labels, {i: any(w.startswith("zux") or w in ("idiot", "Moron,", "worthless") for w in t.split()) for i, t in rows}


def test_score_toxicity(spark):
    rows, labels, truth = toxic_corpus(random.Random(6))
    rows += [(None, "you idiot"), (5000, None), (5001, ""), (5002, "idiotic zuxx? no"), (5003, "bala " * 60_000 + "moron"), (3, rows[3][1])]
    frame = spark.createDataFrame([(*r, "en", 7) for r in rows], "doc_id long, text string, lang string, hits int").repartition(4)
    marks = spark.createDataFrame([(*r, 1) for r in labels] + [(None, 1, 0), (7000, None, 0)], "doc_id long, toxic int, quality int")
    got = toxicity.score_toxicity(frame, marks).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 200 and all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in held)
    assert sum((r["predicted"] == 1) != truth[r["doc_id"]] for r in held) <= 0.01 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert by[None] == 1 and by[5000] == by[5001] == 0 and by[5003] == 1
    kept = toxicity.drop_toxic(frame, marks)
    assert kept.columns == frame.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted(str(r["doc_id"]) for r in got if not r["predicted"])
    unlabelled = toxicity.score_toxicity(frame, marks.limit(0)).collect()
    assert {r["doc_id"]: r["predicted"] for r in unlabelled}[None] == 1
    assert toxicity.score_toxicity(frame.limit(0), marks).count() == 0


def test_votes_respect_word_borders():
    votes = toxicity.Votes(["=scum", "^vequ"])
    assert votes("Scum! scums vequla Xvequ _scum scum") == {0: 2, 1: 1} and votes("") == {}
    assert toxicity.Votes([])("scum") == {}


def test_label_model_finds_accuracies_and_correlation(spark):
    rng = np.random.default_rng(7)
    toxic = rng.random(4000) < 0.2
    first = np.where(toxic, rng.random(4000) < 0.6, rng.random(4000) < 0.01)
    twin = first & (rng.random(4000) < 0.97)
    alone = np.where(toxic, rng.random(4000) < 0.5, rng.random(4000) < 0.02)
    patterns = Counter(tuple(k for k, v in enumerate(x) if v) for x in zip(first, twin, alone, strict=True))
    frame = spark.createDataFrame([(list(k), n) for k, n in patterns.items()], "fired array<int>, n long")
    voters = toxicity.Voters(["=a", "=b", "=c"], np.full(3, 0.4), np.full(3, 0.02), 0.2, 100)
    model = toxicity.fit_label_model(frame, voters)
    assert abs(model.toxic[0] - 0.6) < 0.12 and abs(model.toxic[2] - 0.5) < 0.12 and model.clean.max() < 0.05
    assert model.correlation[0, 1] > 0.7 and model.correlation[0, 2] < 0.3
    assert model.log_odds([0, 1]) < model.log_odds([0, 2])

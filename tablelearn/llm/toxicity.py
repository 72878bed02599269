"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from tablelearn.plans.lineage import checkpointed

from .memory import tidy

# Voters known beforehand: whole words of common abuse in four languages.
LEXICON = [
    "arsehole", "arschloch", "asshole", "bastard", "bitch", "cabron", "cabrón", "clown", "connard", "connasse", "cunt", "degenerate",
    "dickhead", "disgusting", "dumb", "dumbass", "estupido", "estúpido", "fuck", "fucking", "gilipollas", "hurensohn", "idiot", "idiota",
    "idiote", "imbecile", "imbécil", "imbécile", "loser", "mierda", "miststück", "moron", "pathetic", "pendejo", "pute", "salaud",
    "salope", "scheiße", "schlampe", "scum", "shit", "slut", "stupid", "subhuman", "trash", "vermin", "whore", "wichser", "worthless",
]
#: Labelled rows that the mining of voters reads, by the order of a hash of their ids.
TOXIC_ROWS = 3_000
CLEAN_ROWS = 6_000
#: Mined voters: at most so many, each in so many toxic rows, right with this probability, and after different words
#: in the given share of them (up to a number that is enough), as words of one passage and its copies are not.
MAX_MINED = 256
SUPPORT = 5
PRECISION = 0.9
CONTEXT_SHARE = 0.6
CONTEXTS = 12
PREFIXES = (4, 5, 6)
ROUNDS = 6
THRESHOLD = 0.3
_WORD = re.compile(r"\w+")


def terms_of(text: str):
    """(term, word before) of all words and word beginnings; ``=`` marks a whole word, ``^`` a beginning."""
    before = ""
    for word in _WORD.findall(text.lower()):
        yield "=" + word, before
        for size in PREFIXES:
            if len(word) >= size:
                yield "^" + word[:size], before
        before = word


@dataclass
class Voters:
    """The terms in the order of their numbers, with first guesses of P(fires | toxic) and P(fires | clean)."""

    terms: list[str]
    toxic: np.ndarray
    clean: np.ndarray
    prior: float
    rows: int


def sample_labels(labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> DataFrame:
    """(doc_id, toxic) of the labelled training rows that mining reads. An id with several labels is toxic if one is."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out(F.col("doc_id")))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    return known.where("toxic = 1").orderBy(*order).limit(toxic_rows).unionByName(known.where("toxic = 0").orderBy(*order).limit(clean_rows))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def find_voters(docs: DataFrame, labels: DataFrame, lexicon=LEXICON, max_mined: int = MAX_MINED) -> Voters:
    """The lexicon and the words and word beginnings that mark toxic training rows. ``docs``: doc_id, text."""
    sample = F.broadcast(checkpointed(sample_labels(labels)))
    rows = docs.join(sample, "doc_id").select("text", "toxic")

    def count(parts):
        for part in parts:
            for start in range(0, len(part), 200):
                some, found = part.iloc[start:start + 200], {}
                for text, toxic in zip(some["text"], some["toxic"], strict=True):
                    own = {}
                    for term, before in terms_of(text or ""):
                        own.setdefault(term, before)
                    for term, before in own.items():
                        entry = found.setdefault(term, [0, 0, set()])
                        entry[1 - toxic] += 1
                        if toxic and len(entry[2]) < CONTEXTS:
                            entry[2].add(before)
                found[""] = [int(some["toxic"].sum()), int((1 - some["toxic"]).sum()), set()]
                yield pd.DataFrame({"term": list(found), "toxic": [v[0] for v in found.values()], "clean": [v[1] for v in found.values()],
                                    "before": [sorted(v[2]) for v in found.values()]})

    counted = rows.mapInPandas(lambda parts: tidy(count(parts)), "term string, toxic long, clean long, before array<string>").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
        F.size(F.array_distinct(F.flatten(F.collect_list("before")))).alias("contexts"))
    own = ["=" + w for w in lexicon]
    counted = checkpointed(counted.where((F.col("term") == "") | (F.col("toxic") >= SUPPORT) | F.col("term").isin(own)))
    totals = counted.where("term = ''").first()
    n_toxic, n_clean = (totals["toxic"], totals["clean"]) if totals else (0, 0)
    share = known_share(labels)
    right, wrong = F.col("toxic") / max(n_toxic, 1) * share, (F.col("clean") + 0.5) / (n_clean + 0.5) * (1 - share)
    varied = F.col("contexts") >= F.least(F.lit(float(CONTEXTS)), F.col("toxic") * CONTEXT_SHARE)
    mined = counted.where((F.col("term") != "") & (F.col("toxic") >= SUPPORT) & varied & (right >= PRECISION * (right + wrong)))
    mined = mined.orderBy(F.col("toxic").desc(), "clean", F.length("term"), "term").limit(10 * max_mined).collect()
    mined = _shortest(mined)[:max_mined]
    seen = {r["term"]: r for r in counted.where(F.col("term").isin(own)).collect()} | {r["term"]: r for r in mined}
    guess = {}
    for term in [*own, *(r["term"] for r in mined if r["term"] not in set(own))]:
        toxic, clean = (seen[term]["toxic"], seen[term]["clean"]) if term in seen else (0, 0)
        # a lexicon word starts as if one toxic row in twenty and one clean row in two thousand had it
        first = (0.5, 0.005, 10) if term in set(own) else (0.0, 0.05, 1)
        guess[term] = ((toxic + first[0]) / (n_toxic + first[2]), (clean + first[1]) / (n_clean + first[2]))
    return Voters(list(guess), np.array([g[0] for g in guess.values()]), np.array([g[1] for g in guess.values()]), share, n_toxic + n_clean + 20)


def _shortest(rows):
    """Without the terms that a lengthening replaces (cleaner, in nearly as many toxic rows), and without those that only
    lengthen a word beginning which is as clean. ``rows``: by falling number of toxic rows."""
    kept = {}
    for r in rows:
        better = any(e["term"][1:].startswith(r["term"][1:]) and e["clean"] < r["clean"] and e["toxic"] >= 0.9 * r["toxic"] for e in rows)
        starts = ["^" + r["term"][1:size + 1] for size in PREFIXES]
        if not better and not any(kept[s] <= r["clean"] for s in starts if s in kept):
            kept[r["term"]] = r["clean"]
    return [r for r in rows if r["term"] in kept]


def known_share(labels: DataFrame) -> float:
    """Share of toxic rows among the labelled training rows."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id").cast("long")))
    found = rows.agg(F.avg(F.col("toxic").cast("double")).alias("share")).first()["share"]
    return float(min(0.5, max(0.001, found if found is not None else 0.05)))


class Votes:
    """Finds all voters in a text in one pass of an Aho-Corasick automaton."""

    def __init__(self, terms):
        import ahocorasick

        self.machine, entries = ahocorasick.Automaton(), {}
        for number, term in enumerate(terms):
            entries.setdefault(term[1:], []).append((number, term[0] == "="))
        for word, who in entries.items():
            self.machine.add_word(word, (len(word), who))
        if entries:
            self.machine.make_automaton()

    def __call__(self, text: str) -> dict[int, int]:
        """Hits by voter number."""
        low, hits = text.lower(), {}
        for end, (size, who) in self.machine.iter(low) if len(self.machine) else ():
            start = end - size
            if start >= 0 and (low[start].isalnum() or low[start] == "_"):
                continue
            last = end + 1 == len(low) or not (low[end + 1].isalnum() or low[end + 1] == "_")
            for number, whole in who:
                if last or not whole:
                    hits[number] = hits.get(number, 0) + 1
        return hits


@dataclass
class LabelModel:
    """Two classes; voter j votes toxic in the shares ``toxic[j]`` and ``clean[j]`` of their documents and abstains in the
    others. Abstaining depends on a text's length more than on its class and is no evidence, but one voter more votes
    clean where all abstain (``none``: its two shares). A vote counts one over one plus the sum of its correlations,
    inside the toxic class, with the document's other votes, so that voters which repeat each other count once."""

    prior: float
    toxic: np.ndarray
    clean: np.ndarray
    none: tuple[float, float]
    correlation: np.ndarray

    def silent(self) -> float:
        """Log odds of a document without votes."""
        return float(np.log(self.prior / (1 - self.prior)) + np.log(self.none[0] / self.none[1]))

    def log_odds(self, fired) -> float:
        if not len(fired):
            return self.silent()
        at = np.asarray(fired, np.int64)
        says = np.log(np.clip(self.toxic[at], 1e-6, 1) / np.clip(self.clean[at], 1e-6, 1))
        return float(np.log(self.prior / (1 - self.prior)) + (says / (1 + self.correlation[np.ix_(at, at)].sum(axis=1))).sum())


def posterior(model: LabelModel, fired) -> np.ndarray:
    odds = np.array([model.log_odds(f) for f in fired])
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def fit_label_model(patterns: DataFrame, voters: Voters, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over ``patterns`` (fired, n): how many documents have which set of votes. Every document
    counts. Tasks return sums by pairs of voters, so the driver sees numbers of voters, not of documents."""
    size = len(voters.terms)
    model = LabelModel(voters.prior, voters.toxic, voters.clean, (0.1, 0.99), np.zeros((size, size)))
    for _ in range(rounds):

        def sums(parts, model=model):
            both, total, none = {}, np.zeros(2), np.zeros(2)
            for part in parts:
                for fired, n, p in zip(part["fired"], part["n"], posterior(model, part["fired"]), strict=True):
                    total += (n * p, n * (1 - p))
                    none += (0, 0) if len(fired) else (n * p, n * (1 - p))
                    for j in fired:
                        for k in fired:
                            if j <= k:
                                at = both.setdefault((j, k), [0.0, 0.0])
                                at[0] += n * p
                                at[1] += n * (1 - p)
            rows = [(-1, -1, *total), (-2, -2, *none), *((int(j), int(k), *v) for (j, k), v in both.items())]
            yield pd.DataFrame(rows, columns=["j", "k", "toxic", "clean"])

        found = patterns.mapInPandas(sums, "j int, k int, toxic double, clean double").groupBy("j", "k").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()
        joint, total, none = np.zeros((2, size, size)), np.zeros(2), np.zeros(2)
        for r in sorted(found):
            if r["j"] == -1:
                total = np.array([r["toxic"], r["clean"]])
            elif r["j"] == -2:
                none = np.array([r["toxic"], r["clean"]])
            else:
                joint[:, r["j"], r["k"]] = joint[:, r["k"], r["j"]] = r["toxic"], r["clean"]
        if total.sum() == 0:
            return model
        rate = [np.diag(joint[c]) / max(total[c], 1e-9) for c in (0, 1)]
        # the first guesses, from labelled rows where there are any, hold against the votes as so many documents
        toxic = (np.diag(joint[0]) + voters.rows * voters.toxic) / (total[0] + voters.rows)
        clean = (np.diag(joint[1]) + voters.rows * voters.clean) / (total[1] + voters.rows)
        silent = (none + (1, 99)) / (total + (10, 100))
        cover = joint[0] / max(total[0], 1e-9) - np.outer(rate[0], rate[0])
        spread = np.sqrt(np.maximum(rate[0] * (1 - rate[0]), 1e-12))
        correlation = np.clip(cover / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(correlation, 0)
        correlation[:, np.diag(joint[0]) < 1] = correlation[np.diag(joint[0]) < 1] = 0
        model = LabelModel(float(np.clip(total[0] / total.sum(), 1e-4, 0.5)), toxic, clean, (float(silent[0]), float(silent[1])), correlation)
    return model


def features(hits: dict[int, int], size: int) -> np.ndarray:
    """log(1 + hits) of each voter, of all together, and whether any fired."""
    x = np.zeros(size + 2)
    for number, times in hits.items():
        x[number] = np.log1p(times)
    x[size] = np.log1p(sum(hits.values()))
    x[size + 1] = bool(hits)
    return x


@dataclass
class Classifier:
    terms: list[str]
    coefficients: np.ndarray
    intercept: float

    def scores(self, texts) -> np.ndarray:
        votes, size = Votes(self.terms), len(self.terms)
        return np.array([self.score_of(votes(t or ""), size) for t in texts], dtype=float)

    def score_of(self, hits, size: int) -> float:
        odds = self.intercept + (float(features(hits, size) @ self.coefficients) if hits else 0.0)
        return float(1 / (1 + np.exp(-np.clip(odds, -50, 50))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lexicon=LEXICON) -> tuple[Classifier, DataFrame]:
    """The classifier, and the votes (doc_id, numbers, hits) of all documents.

    Only labels of training rows are read, to find voters. The label model sees the votes of all documents and no
    label; the classifier is trained on its posterior for all documents, by patterns of votes.
    """
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    voters = find_voters(table, labels, lexicon)
    terms, size = voters.terms, len(voters.terms)

    def vote(parts):
        finder = Votes(terms)
        for part in parts:
            found = [sorted(finder(t or "").items()) for t in part["text"]]
            yield pd.DataFrame({"doc_id": part["doc_id"], "fired": [[j for j, _ in f] for f in found], "hits": [[n for _, n in f] for f in found]})

    votes = checkpointed(table.mapInPandas(lambda parts: tidy(vote(parts)), "doc_id long, fired array<int>, hits array<int>"))
    patterns = checkpointed(votes.groupBy("fired").agg(F.count(F.lit(1)).alias("n")))
    labeller = fit_label_model(patterns, voters)

    def examples(parts):
        for part in parts:
            p = posterior(labeller, part["fired"])
            x = [features(dict(zip(f, h, strict=True)), size).tolist() for f, h in zip(part["fired"], part["hits"], strict=True)]
            for label, share in ((1.0, p), (0.0, 1 - p)):
                yield pd.DataFrame({"label": label, "weight": part["n"] * share, "x": x})

    amounts = votes.groupBy("fired", "hits").agg(F.count(F.lit(1)).alias("n"))
    rows = checkpointed(amounts.mapInPandas(examples, "label double, weight double, x array<double>").where("weight > 0"))
    if rows.select("label").distinct().count() < 2:
        return Classifier(terms, np.zeros(size + 2), labeller.silent()), votes
    fitted = LogisticRegression(weightCol="weight", maxIter=50, regParam=1e-5, standardization=False).fit(
        rows.select("label", "weight", array_to_vector("x").alias("features")))
    return Classifier(terms, fitted.coefficients.toArray(), float(fitted.intercept)), votes


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row.

    Null and empty texts get the score of a text without votes; a null id is never held out and has no label; rows
    repeated whole score alike; without usable labels the lexicon alone votes; an empty table gives no rows; of ``docs``
    only the two columns are read, so lang, source and columns of any other name have no influence.
    """
    model, votes = train(docs, labels, id_col, text_col)
    size = len(model.terms)

    @F.pandas_udf("double")
    def score(fired: pd.Series, hits: pd.Series) -> pd.Series:
        return pd.Series([model.score_of(dict(zip(f, h, strict=True)), size) for f, h in zip(fired, hits, strict=True)], dtype=float)

    scored = votes.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("fired", "hits").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; all columns stay."""
    model, _ = train(docs, labels, id_col, text_col)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from tidy(pd.Series(model.scores(texts)) for texts in parts)

    return docs.where(score(F.col(f"`{text_col}`").cast("string")) < threshold)

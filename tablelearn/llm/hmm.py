"""A hidden Markov language model trained by Baum-Welch over all training documents."""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tablelearn.plans.lineage import checkpointed

#: At most so many of the most frequent words have an emission of their own; all others share that of their spelling class.
COMMON = 32_768
CLASSES = 4_096
STATES = 8
ROUNDS = 5
#: Training tokens of the shared distribution that each state's emissions are mixed with.
SMOOTHING = 100.0
#: Tokens of a training window: documents are cut into windows, each token is in one.
WINDOW_TOKENS = 512
#: Times that the first guess moves every training window to its likeliest state.
GUESS_ROUNDS = 2
FOLDS, HELD_FOLD = 7, 2
_END = 0


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than ASCII white space, with A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def _name(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _spelling(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_FOLD, F.lit(False))


def count_words(docs: DataFrame) -> DataFrame:
    """(name, class, n) of the words of training documents; the end has the name 0 and the class -1. ``docs``: text of
    the training rows. Tasks count before the shuffle."""

    def count(parts):
        seen, ends = Counter(), 0

        def flush():
            return pd.DataFrame({"name": [_name(w) for w in seen], "class": [_spelling(w) for w in seen], "n": list(seen.values())})

        for part in parts:
            ends += len(part)
            for text in part["text"]:
                seen.update(words_of(text))
                if len(seen) > 400_000:
                    yield flush()
                    seen.clear()
        if seen:
            yield flush()
        if ends:
            yield pd.DataFrame({"name": [_END], "class": [-1], "n": [ends]})

    return docs.mapInPandas(count, "name long, class int, n long").groupBy("name", "class").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Symbols: the common words, then the spelling classes, then the end. ``many``: training count of each common word
    and of the end; ``mass``: for each class the sum of count + 1 over its words, and 1 for its unknown words."""

    names: np.ndarray
    many: np.ndarray
    mass: np.ndarray
    ends: int
    tokens: int
    words: int

    @property
    def symbols(self) -> int:
        return len(self.names) + CLASSES + 1

    def shared(self) -> np.ndarray:
        """The distribution of symbols without states."""
        weight = np.concatenate([self.many + 1.0, self.mass, [self.ends + 1.0]])
        return weight / weight.sum()


def read_vocabulary(counts: DataFrame, common: int = COMMON) -> tuple[Vocabulary, DataFrame]:
    """The bounded vocabulary, and the counts of the words outside it, which stay a table."""
    totals = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("words"), F.sum(F.expr("CASE WHEN class < 0 THEN n END")).alias("ends")).first()
    words = counts.where("class >= 0")
    # the least count that at most ``common`` words reach; words of equal count stay together
    room, least = common, None
    for r in sorted(words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        if r["words"] > room:
            break
        room, least = room - r["words"], r["n"]
    top = words.where(F.col("n") >= least).collect() if least is not None else []  # bounded by the parameter
    top.sort(key=lambda r: (-r["n"], r["name"]))
    rare = words.where(F.col("n") < least) if least is not None else words
    mass = np.ones(CLASSES)
    for r in rare.groupBy("class").agg(F.sum(F.col("n") + 1).alias("mass")).collect():
        mass[r["class"]] += r["mass"]
    names, many = np.array([r["name"] for r in top], np.int64), np.array([r["n"] for r in top], np.float64)
    return Vocabulary(names, many, mass, int(totals["ends"] or 0), int(totals["tokens"] or 0), int(totals["words"])), rare


class Speller(dict):
    """word -> place in the arrays ``symbol`` and ``name``, remembered for the words seen lately."""

    def __init__(self, names: np.ndarray, limit: int = 400_000):
        super().__init__()
        self.common = {int(n): k for k, n in enumerate(names)}
        self.offset, self.limit = len(names), limit
        self.symbol, self.name = array("i"), array("q")

    def __missing__(self, word: bytes) -> int:
        name = _name(word)
        symbol = self.common.get(name)
        self.symbol.append(self.offset + _spelling(word) if symbol is None else symbol)
        self.name.append(name)
        place = self[word] = len(self.symbol) - 1
        return place

    def forget(self) -> None:
        if len(self) > self.limit:
            self.clear()
            del self.symbol[:], self.name[:]


def encode(docs: DataFrame, names: np.ndarray) -> DataFrame:
    """(doc_id, row, held_out, tokens, rare): the symbols of each document with the end, and the names of its words that
    are not common."""
    end = len(names) + CLASSES

    def run(parts):
        spell = Speller(names)
        for part in parts:
            for start in range(0, len(part), 256):
                some = part.iloc[start:start + 256]
                lists = [words_of(t) for t in some["text"]]
                sizes = np.array([len(w) for w in lists])
                places = np.fromiter(map(spell.__getitem__, chain.from_iterable(lists)), np.int64, int(sizes.sum()))
                symbols, known = np.array(spell.symbol, np.int32), np.array(spell.name, np.int64)
                spell.forget()
                cuts = np.cumsum(sizes)[:-1]
                tokens, found = [], []
                for at in np.split(places, cuts):
                    own = symbols[at] if len(at) else np.zeros(0, np.int32)
                    tokens.append(np.append(own, np.int32(end)))
                    found.append(known[at[own >= len(names)]] if len(at) else np.zeros(0, np.int64))
                yield some[["doc_id", "row", "held_out"]].assign(tokens=tokens, rare=found)

    return docs.mapInPandas(run, "doc_id long, row long, held_out boolean, tokens array<int>, rare array<long>")


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def batches(sequences, most: int = 512, tokens: int = 200_000):
    """Groups of sequences of like length, longest first: (indices, padded symbols as time x sequence, lengths)."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        longest = max(1, sizes[order[at]])
        take = order[at:at + max(1, min(most, tokens // longest))]
        grid = np.zeros((longest, len(take)), np.int32)
        for k, i in enumerate(take):
            grid[:sizes[i], k] = sequences[i]
        yield take, grid, sizes[take]
        at += len(take)


def log_likelihood(model: Model, sequences) -> np.ndarray:
    """log10 probability of each sequence by the scaled forward recursion, over the whole sequence."""
    out, ones = np.zeros(len(sequences)), np.ones(len(model.start))
    for take, grid, sizes in batches(sequences, tokens=4_000_000):
        total, state = np.zeros(len(take)), None
        alive = np.searchsorted(-sizes, -np.arange(len(grid)), side="left")  # sequences longer than t
        for t in range(len(grid)):
            n = alive[t]
            seen = model.emit.take(grid[t, :n], axis=0)
            seen *= model.start if t == 0 else state[:n] @ model.move
            scale = seen @ ones
            total[:n] += np.log10(scale)
            seen *= (1 / scale)[:, None]
            state = seen
        out[take] = total
    return out


def expected_counts(model: Model, sequences, opens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of one set of windows: starts, moves, emissions. ``opens``: whether a window opens its document."""
    states, ones = len(model.start), np.ones(len(model.start))
    starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.size)
    for take, grid, sizes in batches(sequences):
        steps, width = grid.shape
        alive = np.searchsorted(-sizes, -np.arange(steps), side="left")
        forward, scales = np.zeros((steps, width, states)), np.ones((steps, width))  # scales: one over the sums
        for t in range(steps):
            n = alive[t]
            state = model.emit.take(grid[t, :n], axis=0)
            state *= model.start if t == 0 else forward[t - 1, :n] @ model.move
            scale = state @ ones
            np.divide(1, scale, out=scales[t, :n])
            np.multiply(state, scales[t, :n, None], out=forward[t, :n])
        back = np.ones((width, states))
        for t in range(steps - 1, 0, -1):
            n = alive[t]
            seen = model.emit.take(grid[t, :n], axis=0)
            seen *= back[:n]
            seen *= scales[t, :n, None]
            moves += forward[t - 1, :n].T @ seen
            forward[t, :n] *= back[:n]
            back[:n] = seen @ model.move.T
        forward[0] *= back
        starts += forward[0][np.asarray(opens)[take]].sum(axis=0)
        here = np.arange(steps)[:, None] < sizes[None, :]
        cell = grid[here][:, None] * states + np.arange(states)
        emits += np.bincount(cell.ravel(), weights=forward[here].ravel(), minlength=len(emits))
    return starts, moves * model.move, emits.reshape(model.emit.shape)


def normalised(starts, moves, emits, shared: np.ndarray, smoothing: float = SMOOTHING) -> Model:
    states = len(starts)
    start = (starts + 1) / (starts.sum() + states)
    move = (moves + 0.1) / (moves.sum(axis=1, keepdims=True) + 0.1 * states)
    return Model(start, move, (emits + smoothing * shared[:, None]) / (emits.sum(axis=0) + smoothing))


def directions(vocabulary: Vocabulary, states: int) -> np.ndarray:
    """symbols x bits: +1 or -1 by a hash of the symbol's name, less the mean over the training tokens."""
    bits = max(1, (states - 1).bit_length())
    names = [int(n).to_bytes(8, "little", signed=True) for n in vocabulary.names]
    names += [b"%d" % c for c in range(CLASSES + 1)]
    signs = np.array([xxhash.xxh3_64_intdigest(n) for n in names], np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64) & np.uint64(1)
    signs = signs.astype(np.float64) * 2 - 1
    return signs - vocabulary.shared() @ signs


def window_groups(texts, most: int = 131_072):
    """The windows of all texts, about ``most`` tokens at a time: their tokens in a row, and their sizes."""
    held, size = [], 0
    for tokens in texts:
        for start in range(0, len(tokens), WINDOW_TOKENS):
            held.append(tokens[start:start + WINDOW_TOKENS])
            size += len(held[-1])
            if size >= most:
                yield np.concatenate(held), np.fromiter(map(len, held), np.int64, len(held))
                held, size = [], 0
    if held:
        yield np.concatenate(held), np.fromiter(map(len, held), np.int64, len(held))


def window_sums(tokens: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each window the sum of its symbols' rows of ``weights``."""
    return np.add.reduceat(weights.take(tokens, axis=0), np.cumsum(sizes) - sizes, axis=0)


def sides(tokens: np.ndarray, sizes: np.ndarray, planes: np.ndarray, states: int) -> np.ndarray:
    """The state of each window: on which side of each plane through the mean it lies."""
    return ((window_sums(tokens, sizes, planes) > 0) @ (1 << np.arange(planes.shape[1]))) % states


def likeliest(tokens: np.ndarray, sizes: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The state of each window: under whose emissions its words are likeliest, the first of equals."""
    return window_sums(tokens, sizes, logs).argmax(axis=1)


def first_guess(training: DataFrame, vocabulary: Vocabulary, states: int, rounds: int = GUESS_ROUNDS) -> Model:
    """Emissions counted over all training windows, each of which belongs to one state: at first by random planes, then
    ``rounds`` times by the likeliest state. Nothing depends on the order of rows, as only whole numbers are summed."""
    shared, choose = vocabulary.shared(), (sides, directions(vocabulary, states), states)
    moves = np.eye(states) * 100 + np.random.default_rng(0).random((states, states))
    columns = [f"s{s}" for s in range(states)]
    size = vocabulary.symbols
    for _ in range(rounds + 1):

        def count(parts, choose=choose):
            own, *rest = choose
            total = np.zeros(size * states, np.int64)
            for part in parts:
                for tokens, sizes in window_groups(part["tokens"]):
                    state = np.repeat(own(tokens, sizes, *rest), sizes)
                    total += np.bincount(tokens * np.int64(states) + state, minlength=len(total))
            grid = total.reshape(size, states)
            used = np.flatnonzero(grid.any(axis=1))
            yield pd.DataFrame(grid[used], columns=columns).assign(at=used)[["at", *columns]]

        summed = training.select("tokens").mapInPandas(count, "at int, " + ", ".join(f"{c} long" for c in columns))
        emits = np.zeros((size, states))
        for r in summed.groupBy("at").agg(*[F.sum(c) for c in columns]).collect():  # as large as the bounded alphabet
            emits[r["at"]] = r[1:]
        model = normalised(np.ones(states), moves, emits, shared)
        choose = likeliest, np.log(model.emit)
    return model


def train(encoded: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the training rows of ``encoded``. A round is one pass; tasks return expected counts by symbol, a
    table as large as the bounded alphabet."""
    training = encoded.where("NOT held_out").select("tokens")
    model, shared = first_guess(training, vocabulary, states), vocabulary.shared()
    columns = [f"s{s}" for s in range(states)]
    schema = "kind int, at int, " + ", ".join(f"{c} double" for c in columns)
    for _ in range(rounds):

        def expect(parts, model=model):
            total = None
            for part in parts:
                for begin in range(0, len(part), 2048):  # many texts, so that windows of like length meet
                    some = [np.asarray(t) for t in part["tokens"].iloc[begin:begin + 2048]]
                    windows = [t[k:k + WINDOW_TOKENS] for t in some for k in range(0, len(t), WINDOW_TOKENS)]
                    opens = [k == 0 for t in some for k in range(0, len(t), WINDOW_TOKENS)]
                    found = expected_counts(model, windows, opens)
                    total = found if total is None else tuple(a + b for a, b in zip(total, found, strict=True))
            if total is not None:
                starts, moves, emits = total
                used = np.flatnonzero(emits.sum(axis=1) > 0)
                kind = np.concatenate([[0], np.ones(len(moves), int), np.full(len(used), 2)])
                at = np.concatenate([[0], np.arange(len(moves)), used])
                yield pd.DataFrame(np.concatenate([starts[None], moves, emits[used]]), columns=columns).assign(kind=kind, at=at)[["kind", "at", *columns]]

        summed = training.mapInPandas(expect, schema).groupBy("kind", "at").agg(*[F.sum(c).alias(c) for c in columns])
        starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((vocabulary.symbols, states))
        for r in summed.collect():
            (starts if r["kind"] == 0 else moves[r["at"]] if r["kind"] == 1 else emits[r["at"]])[:] = r[2:]
        model = normalised(starts, moves, emits, shared)
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", common: int = COMMON, states: int = STATES,
                rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Scores are log10 probabilities of the whole text with its end. The hidden states emit symbols: a common word, a
    spelling class (the last three bytes) or the end. A word that is not common then has the probability (c + 1) / mass
    within its class, an unknown word 1 / mass; so known words and one unknown word per class share the whole
    probability, and the score of an unknown word is never above that of a model with a single one.

    Rows in another order or layout give the same scores up to rounding.

    Null and empty texts are the end alone; a null id is a training row; rows repeated whole count each; an empty table
    gives no rows; other columns are not read.
    """
    table = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = table.withColumn("held_out", held_out(F.col("doc_id")))
    counts = checkpointed(count_words(table.where("NOT held_out").select("text")))
    vocabulary, rare = read_vocabulary(counts, common)
    names = vocabulary.names
    encoded = checkpointed(encode(table.withColumn("row", F.monotonically_increasing_id()), names))
    model = train(encoded, vocabulary, states, rounds)

    lookups = encoded.select("row", F.explode("rare").alias("name")).join(rare.select("name", "n"), "name", "left")
    found = lookups.groupBy("row").agg(F.count("n").alias("known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("logs"))
    many, mass, ends = np.log10(vocabulary.many + 1), np.log10(vocabulary.mass), float(np.log10(vocabulary.ends + 1))
    level, end_known = float(np.log10(vocabulary.tokens + vocabulary.words + 1)), vocabulary.ends > 0
    log_base = np.concatenate([many, np.zeros(CLASSES), [ends]])
    log_class = np.concatenate([np.zeros(len(many)), mass, [0.0]])

    def score(parts):
        for part in parts:
            for begin in range(0, len(part), 4096):
                some = part.iloc[begin:begin + 4096]
                tokens = [np.asarray(t) for t in some["tokens"]]
                hidden = log_likelihood(model, tokens)
                yield pd.DataFrame({
                    "doc_id": some["doc_id"], "row": some["row"], "held_out": some["held_out"], "n_tokens": [len(t) for t in tokens],
                    "sure": [int((t < len(many)).sum()) + int(end_known) for t in tokens],
                    "base": [float(log_base[t].sum()) - len(t) * level for t in tokens],
                    "hidden": [h - float(log_class[t].sum()) for h, t in zip(hidden, tokens, strict=True)]})

    scored = encoded.select("doc_id", "row", "held_out", "tokens").mapInPandas(
        score, "doc_id long, row long, held_out boolean, n_tokens long, sure long, base double, hidden double")
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("sure") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), (F.col("base") + logs).alias("base_score"),
        (F.col("hidden") + logs).alias("score"))

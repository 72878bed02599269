"""Hard negatives by threshold joins: partial inner products, remaining norms, thresholds that fall until windows fill."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tablelearn.plans.lineage import checkpointed

#: Positives of an anchor, negatives of a positive, and the band of a negative's score in hundredths of the positive's.
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
SCALE = 256.0
#: Anchors in a task's block; rows of a slice; anchors and rows whose partial scores are held at a time.
ANCHOR_ROWS, SLICE_ROWS = 4096, 500_000
QUERY_ROWS, INDEX_ROWS = 256, 2048
#: Dimensions between two looks at the remaining norms.
STEP = 8
#: Shares of the highest score possible at which an open window is tried, before all that it can still take.
SHARES = (0.9, 0.75, 0.6, 0.45, 0.3)
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def matrix(vectors, width: int | None = None) -> np.ndarray:
    """Integer components as doubles, short vectors filled up with zeros."""
    rows = [np.floor(SCALE * np.asarray(v, dtype=np.float64)) for v in vectors]
    out = np.zeros((len(rows), max(width or 0, max(map(len, rows), default=0))))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    """Norm of each row from every STEP-th dimension on; the last column is 0."""
    squares = np.zeros((len(x), -(-x.shape[1] // STEP) + 1))
    for c in range(squares.shape[1] - 2, -1, -1):
        part = x[:, c * STEP : (c + 1) * STEP]
        squares[:, c] = squares[:, c + 1] + (part * part).sum(axis=1)
    return np.sqrt(squares)


class Index:
    """Rows of one piece, dimension by dimension, in an order in which the dimensions with most weight come first."""

    def __init__(self, x: np.ndarray):
        self.x, self.norms = x, _norms(x)
        self.most = float(self.norms[:, 0].max()) if len(x) else 0.0

    def above(self, q: np.ndarray, q_norms: np.ndarray, low: np.ndarray):
        """(i, j, score) of all pairs with score >= low[i], exactly.

        With t the least threshold, a row's dimensions from the first step on at which its remaining norm times the
        largest remaining norm of an anchor is below t are left out of the index: such a pair cannot reach t without a
        score before. Partial scores are added up over indexed dimensions; a pair goes when partial score plus the
        product of its remaining norms is below its threshold. What stays is completed with the omitted dimensions.
        """
        big = len(q) and self.most * float(q_norms[:, 0].max()) >= _EXACT
        if big or not len(q) or not len(self.x):
            return self._plain(q, low, big)
        steps = self.norms.shape[1] - 1
        rows, cols = np.arange(len(q)), np.arange(len(self.x))
        reach = self.norms * q_norms.max(axis=0)[None, :] * (1 + 1e-9) + 1e-6
        covered = reach < low.min()
        end = np.where(covered.any(axis=1), covered.argmax(axis=1), steps)
        part = np.zeros((len(rows), len(cols)))
        for c in range(steps):
            if not len(rows) or not len(cols):
                break
            dims = slice(c * STEP, (c + 1) * STEP)
            indexed = end[cols] > c
            if indexed.all():
                part += q[rows, dims] @ self.x[cols, dims].T
            elif indexed.any():
                part[:, indexed] += q[rows, dims] @ self.x[cols[indexed], dims].T
            alive = part + self._rest(q_norms, rows, cols, end, c + 1) >= low[rows][:, None]
            stay, go_on = alive.any(axis=1), alive.any(axis=0)
            if stay.mean() < 0.8 or go_on.mean() < 0.8:
                part, rows, cols = part[np.ix_(stay, go_on)], rows[stay], cols[go_on]
        if not len(rows) or not len(cols):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        a, b = np.nonzero(part + self._rest(q_norms, rows, cols, end, steps) >= low[rows][:, None])
        i, j, score = rows[a], cols[b], part[a, b]
        for c in range(int(end[j].min()) if len(j) else steps, steps):
            dims, left = slice(c * STEP, (c + 1) * STEP), np.flatnonzero(end[j] <= c)
            score[left] += np.einsum("ij,ij->i", q[i[left], dims], self.x[j[left], dims])
        real = score >= low[i]
        return i[real], j[real], score[real]

    def _rest(self, q_norms, rows, cols, end, step):
        """The most that the dimensions not yet added can give each pair."""
        if (end[cols] >= step).all():
            return np.outer(q_norms[rows, step], self.norms[cols, step]) * (1 + 1e-9) + 1e-6
        at = np.minimum(end[cols], step)
        return q_norms[np.ix_(rows, at)] * self.norms[cols, at][None, :] * (1 + 1e-9) + 1e-6

    def _plain(self, q, low, big):
        """All scores; in Python's integers where doubles would round."""
        if not len(q) or not len(self.x):
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(0)
        whole = np.vectorize(int, otypes=[object])
        score = whole(q) @ whole(self.x).T if big else q @ self.x.T
        i, j = np.nonzero(score >= low[:, None])
        return i, j, score[i, j]


class Windows:
    """For each window (an anchor, lowest and highest score) the ``k`` best rows met so far."""

    def __init__(self, owner: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.owner, self.low, self.high, self.k = owner, low, high, k
        self.at, self.score, self.name = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.need = np.where(low <= high, low, np.inf)

    def add(self, at: np.ndarray, score: np.ndarray, name: np.ndarray) -> None:
        fits = (score >= self.need[at]) & (score <= self.high[at])
        at, score, name = (np.concatenate(p) for p in ((self.at, at[fits]), (self.score, score[fits]), (self.name, name[fits])))
        order = np.lexsort((name, -score if score.dtype != object else [-s for s in score], at))
        at, score, name = at[order], score[order], name[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        self.at, self.score, self.name = at[rank < self.k], score[rank < self.k], name[rank < self.k]
        full = rank == self.k - 1
        self.need[at[full]] = score[full].astype(float)


def fill(windows: Windows, q: np.ndarray, q_norms: np.ndarray, q_names, q_labels, index: Index, names, labels, same: bool) -> None:
    """Give the windows all rows of the index that belong to them.

    Each round joins the anchors with open windows at their present threshold. A window is done when it is full down to
    the threshold or takes nothing below it; the others fall to the next share of the highest score possible, in the end
    to the least score that they can still take.
    """
    top = np.minimum(windows.high, q_norms[windows.owner, 0] * index.most)
    seen = np.full(len(q), np.inf)
    open_ = windows.need <= top
    for share in (*SHARES, None):
        if not open_.any():
            return
        aim = windows.need if share is None else np.maximum(windows.need, np.where(top > 0, np.floor(top * share), windows.need))
        low = np.full(len(q), np.inf)
        np.minimum.at(low, windows.owner[open_], aim[open_])
        some = np.flatnonzero(low < seen)
        i, j, score = index.above(q[some], q_norms[some], low[some])
        i = some[i]
        fits = (score < seen[i]) & ((labels[j] == q_labels[i]) == same) & (names[j] != q_names[i])
        i, j, score = i[fits], j[fits], score[fits]
        first, many = np.searchsorted(windows.owner, np.arange(len(q))), np.bincount(windows.owner, minlength=len(q))
        times = many[i]
        at = np.repeat(first[i], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        windows.add(at, np.repeat(score, times), np.repeat(names[j], times))
        seen = np.minimum(seen, low)
        open_ &= windows.need < low[windows.owner]


def _search(vectors: DataFrame, anchors: DataFrame, total: int, anchor_total: int, k: int, same: bool) -> DataFrame:
    """(anchor_id, place, other_id, score): the k best rows of each anchor's windows in each slice of the rows.

    ``anchors`` has vec_id, label, vec and the lists ``low`` and ``high``, a window each. Anchors lie in blocks of about
    ANCHOR_ROWS; every block meets every slice in one task, which keeps the block, reads the slice in batches and holds
    the best rows alone. Slices hold SLICE_ROWS rows at most (fewer on a small table, to use all cores).
    """
    spark = vectors.sparkSession
    blocks = max(1, -(-anchor_total // ANCHOR_ROWS))
    cores = spark.sparkContext.defaultParallelism
    slices = max(1, -(-total // SLICE_ROWS), min(-(-2 * cores // blocks), -(-total // INDEX_ROWS)))
    asked = anchors.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.lit(0).alias("kind"), "vec_id", "label", "vec", "low", "high",
    )
    none = F.lit(None).cast("array<double>")
    held = vectors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(slices)).cast("int").alias("slice"),
        F.lit(1).alias("kind"), "vec_id", "label", "vec", none.alias("low"), none.alias("high"),
    )
    dealt = asked.unionByName(held).repartition(blocks * slices, "block", "slice").sortWithinPartitions("block", "slice", "kind")

    def work(parts):
        key, asked, task = None, [], None
        for part in parts:
            for k_, piece in part.groupby(["block", "slice"], sort=True):
                if k_ != key:
                    if task is not None:
                        yield from task.found()
                    key, asked, task = k_, [], None
                asked.append(piece[piece["kind"] == 0])
                rows = piece[piece["kind"] == 1]
                if len(rows):
                    if task is None:
                        task = _Task(pd.concat(asked), k, same)
                    task.read(rows)
        if task is not None:
            yield from task.found()

    return dealt.mapInPandas(work, "anchor_id long, place int, other_id long, score long")


class _Task:
    """A block of anchors that meets the rows of one slice, batch by batch."""

    def __init__(self, anchors: pd.DataFrame, k: int, same: bool):
        self.same, self.names, self.labels = same, anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
        q = matrix(anchors["vec"])
        with np.errstate(over="ignore"):
            self.order = np.argsort(-(q * q).sum(axis=0), kind="stable")
        self.q, self.blocks = q, []
        low, high = anchors["low"].to_list(), anchors["high"].to_list()
        for start in range(0, len(q), QUERY_ROWS):
            rows = range(start, min(len(q), start + QUERY_ROWS))
            many = [len(low[r]) for r in rows]
            owner = np.repeat(np.arange(len(rows)), many)
            flat = [np.concatenate([np.asarray(side[r], float) for r in rows]) if len(rows) else np.zeros(0) for side in (low, high)]
            self.blocks.append((start, Windows(owner, *flat, k), np.concatenate([np.arange(m) for m in many])))

    def read(self, rows: pd.DataFrame) -> None:
        x = matrix(rows["vec"], self.q.shape[1])
        if x.shape[1] > self.q.shape[1]:  # components that no anchor has yet
            extra = np.arange(self.q.shape[1], x.shape[1])
            self.q, self.order = np.pad(self.q, ((0, 0), (0, len(extra)))), np.concatenate([self.order, extra])
        x, q = x[:, self.order], self.q[:, self.order]
        names, labels, norms = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), _norms(q)
        for start in range(0, len(x), INDEX_ROWS):
            own, kinds = names[start : start + INDEX_ROWS], labels[start : start + INDEX_ROWS]
            piece = x[start : start + INDEX_ROWS]
            if not self.same:
                index = Index(piece)
                for first, windows, _ in self.blocks:
                    at = slice(first, first + QUERY_ROWS)
                    fill(windows, q[at], norms[at], self.names[at], self.labels[at], index, own, kinds, False)
                continue
            for label in np.unique(kinds):  # rows of another label are not looked at
                mine = kinds == label
                index = Index(piece[mine])
                for first, windows, _ in self.blocks:
                    at = slice(first, first + QUERY_ROWS)
                    here = np.flatnonzero(self.labels[at] == label)
                    if len(here):
                        self._part(windows, here, q[at], norms[at], self.names[at], self.labels[at], index, own[mine], kinds[mine])

    def _part(self, windows, here, q, norms, names, labels, index, own, kinds):
        """The windows of some anchors alone."""
        picked = np.flatnonzero(np.isin(windows.owner, here))
        old = np.isin(windows.at, picked)
        part = Windows(np.searchsorted(here, windows.owner[picked]), windows.low[picked], windows.high[picked], windows.k)
        part.at, part.score, part.name, part.need = np.searchsorted(picked, windows.at[old]), windows.score[old], windows.name[old], windows.need[picked]
        fill(part, q[here], norms[here], names[here], labels[here], index, own, kinds, True)
        windows.at = np.concatenate([windows.at[~old], picked[part.at]])
        windows.score, windows.name = np.concatenate([windows.score[~old], part.score]), np.concatenate([windows.name[~old], part.name])
        windows.need[picked] = part.need

    def found(self):
        for start, windows, place in self.blocks:
            score = [max(-_LONG - 1, min(_LONG, int(s))) for s in windows.score]
            yield pd.DataFrame({"anchor_id": self.names[start + windows.owner[windows.at]], "place": place[windows.at].astype("int32"), "other_id": windows.name, "score": pd.array(score, dtype="int64")})


def usable_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, one per id."""
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v * F.lit(SCALE)) == float("inf")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    table = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("vec"))
    table = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & ~bad)
    return table.groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("r")).select("vec_id", "r.label", "r.vec")


def hard_negatives(rows: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors (ids divisible by ``every``).

    An anchor's positives are its ``positives`` best rows of the same label; a positive's negatives are the ``negatives``
    best rows of other labels whose score lies between ``low`` and ``high`` hundredths of the positive's. Scores are
    inner products of floor(256 x); ties go to the smaller id. Where an id is divisible by 7 the label moves on by one
    (modulo 10).

    Rows with a null id, label or vector, or with a null or non-finite component (or one that 256 x makes so), take no
    part; of rows that repeat an id the least (label, vector) does. Short vectors count as filled up with zeros, so an
    empty vector scores 0. A negative positive score has an empty band. An anchor without positives, or a band without
    rows, gives no rows; an empty table none. Scores beyond 64 bits are reported as the nearest 64-bit number.
    """
    vectors = checkpointed(usable_vectors(rows))
    total = vectors.count()
    anchors = vectors.where(F.col("vec_id") % every == 0)
    anchor_total = anchors.count()
    wide = anchors.withColumn("low", F.array(F.lit(float("-inf")))).withColumn("high", F.array(F.lit(float("inf"))))
    found = _search(vectors, wide, total, anchor_total, positives, True)
    near = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    first = checkpointed(found.withColumn("r", F.row_number().over(near)).where(F.col("r") <= positives).select("anchor_id", "r", "other_id", "score"))
    # the band's ends as whole numbers: 100 n >= low p and 100 n <= high p
    ends = first.select(
        "anchor_id", "r", F.ceil(F.col("score").cast("decimal(38,0)") * low / 100).cast("double").alias("low"),
        F.floor(F.col("score").cast("decimal(38,0)") * high / 100).cast("double").alias("high"),
    )
    bands = ends.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("r", "low", "high"))).alias("b"))  # ``positives`` of them
    bands = bands.select(F.col("anchor_id").alias("vec_id"), F.col("b.low").alias("low"), F.col("b.high").alias("high"))
    taken = _search(vectors, anchors.join(bands, "vec_id"), total, anchor_total, negatives, False)
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "other_id")
    taken = taken.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    told = taken.select("anchor_id", (F.col("place") + 1).alias("r"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return first.join(told, ["anchor_id", "r"]).select(
        "anchor_id", F.col("other_id").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )


def hard_negatives_sql(every: int = 50) -> str:
    """The same in DuckDB's SQL: the stated query set against all rows."""
    return f"""
WITH x AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * v::DOUBLE) FOR v IN embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
      FROM x a JOIN x b ON a.vec_id % {every} = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INT AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""


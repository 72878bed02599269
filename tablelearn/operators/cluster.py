"""K-Means, DBSCAN, agglomerative, spectral and mean-shift clustering."""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans as MLKMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from ..core import Fitted, Operator
from ..functions.columns import feature_array, feature_vector, names, require
from ..plans.balls import INLINE_VALUES, modes_inline, packed, packed_sums
from ..plans.density import cluster_points
from ..plans.lineage import checkpointed
from ..plans.linkage import cut_tree, merges
from ..plans.neighbors import PivotCells, _ints, _matrix, distances, internal_metric, knn, points, to_internal
from ..plans.nystroem import LANDMARKS, rbf_embedding
from ..plans.ranking import running_total
from ..plans.skew import hot_safe_join
from ..plans.subspace import graph_embedding
from ..plans.sums import lists_to_matrix, sum_vectors


UNROLLED_COLUMNS = 16


def squared_gap(x: Column, center: list[float]) -> Column:
    """Squared Euclidean distance of an array column to a fixed point. Few columns: codegen arithmetic; many: one
    array expression, so the generated code stays small."""
    if len(center) > UNROLLED_COLUMNS:
        point = F.array(*[F.lit(float(c)) for c in center])
        return F.aggregate(F.zip_with(x, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v)
    parts = [(x[i] - F.lit(float(c))) * (x[i] - F.lit(float(c))) for i, c in enumerate(center)]
    return sum(parts[1:], parts[0])


class KMeans(Operator):
    """``k-means++`` starts from the parallel k-means|| seeding of ``pyspark.ml``; ``random`` starts from the k rows
    that come first in a seeded hash order of ``id_col`` and runs Lloyd rounds as one grouped aggregate each.
    The best of ``n_init`` starts by inertia is kept."""

    def __init__(self, cols, k=3, init="k-means++", max_iter=300, n_init=10, seed=42, tol=1e-4, id_col=None):
        super().__init__()
        if init not in ("k-means++", "random"):
            raise ValueError("init must be k-means++ or random")
        if init == "random" and id_col is None:
            raise ValueError("init='random' needs id_col")
        self.cols, self.k, self.init, self.max_iter, self.n_init = names(cols), int(k), init, int(max_iter), int(n_init)
        self.seed, self.tol, self.id_col = seed, float(tol), id_col

    def _fit(self, df):
        require(df, self.cols + ([self.id_col] if self.id_col else []))
        best = None
        if self.init == "k-means++":
            data = df.select(feature_vector(df, self.cols).alias("features")).persist()
            try:
                for i in range(self.n_init):
                    m = MLKMeans(k=self.k, maxIter=self.max_iter, seed=self.seed + i, tol=self.tol).fit(data)
                    if best is None or m.summary.trainingCost < best[0]:
                        best = (m.summary.trainingCost, [list(map(float, c)) for c in m.clusterCenters()], m.summary.numIter)
            finally:
                data.unpersist()
        else:
            rows = df.select(F.col(f"`{self.id_col}`").cast("string").alias("id"), feature_array(df, self.cols).alias("x")).persist()
            try:
                for i in range(self.n_init):
                    found = self._lloyd(rows, self.seed + i)
                    best = found if best is None or found[0] < best[0] else best
            finally:
                rows.unpersist()
        return KMeansModel(cols=self.cols, centers=best[1], inertia=float(best[0]), n_iter=best[2], k=len(best[1]))

    def _lloyd(self, rows, seed):
        start = rows.orderBy(F.md5(F.concat("id", F.lit(f"-{seed}")))).limit(self.k).collect()
        centers = [list(r.x) for r in start]
        if len(centers) < self.k:
            raise ValueError("fewer rows than clusters")
        d = len(centers[0])
        scale = rows.agg(*[F.var_pop(F.col("x")[j]) for j in range(d)]).first()
        limit = self.tol * sum(scale) / d
        done = 0
        for done in range(1, self.max_iter + 1):
            tagged = rows.select("x", nearest(F.col("x"), centers).alias("c"))
            means = tagged.groupBy("c").agg(*[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(d)]).collect()
            moved = [list(c) for c in centers]
            for r in means:
                moved[r.c] = [r[f"m{j}"] for j in range(d)]
            shift = sum((a - b) ** 2 for p, q in zip(centers, moved) for a, b in zip(p, q))
            centers = moved
            if shift <= limit:
                break
        gaps = F.array(*[squared_gap(F.col("x"), c) for c in centers])
        return rows.agg(F.sum(F.array_min(gaps))).first()[0], centers, done


def nearest(x: Column, centers: list[list[float]]) -> Column:
    """Index of the nearest centre; the first one on a tie."""
    gaps = F.array(*[squared_gap(x, c) for c in centers])
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")


class KMeansModel(Fitted):
    def _transform(self, df):
        """``cluster`` and ``distances_to_centers``."""
        require(df, self.cols)
        out = df.withColumn("_x", feature_array(df, self.cols))
        gaps = F.array(*[F.sqrt(squared_gap(F.col("_x"), c)) for c in self.centers])
        out = out.withColumn("distances_to_centers", gaps).drop("_x")
        return out.withColumn("cluster", (F.array_position("distances_to_centers", F.array_min("distances_to_centers")) - 1).cast("int"))


def distinct_points(rows: DataFrame) -> DataFrame:
    """(id, x) -> (key, x, w): one row per distinct x with its smallest id and its number of copies."""
    return rows.groupBy("x").agg(F.min("id").alias("key"), F.count(F.lit(1)).alias("w")).select("key", "x", "w")


def numbered(labels: DataFrame, label: str) -> DataFrame:
    """(label, cluster): clusters numbered from 0 in label order, whatever their count."""
    return running_total(labels.select(label).where(F.col(label).isNotNull()).distinct().withColumn("one", F.lit(1)), [label], "one", "cluster").select(
        label, F.col("cluster").cast("int").alias("cluster")
    )


def density_labels(df: DataFrame, id_col: str, cols: list[str], eps: float, min_samples: int, metric: str) -> DataFrame:
    """All rows plus ``cluster`` (-1 = noise, numbered by smallest core id), ``is_core_sample``, ``is_noise``."""
    rows = checkpointed(points(df, id_col, cols, metric))
    unique = checkpointed(distinct_points(rows))
    first = unique.select(F.size("x").alias("d")).first()
    if first is None:
        return df.select("*", F.lit(-1).alias("cluster"), F.lit(False).alias("is_core_sample"), F.lit(True).alias("is_noise"))
    found = checkpointed(cluster_points(unique, first.d, to_internal(eps, metric), int(min_samples), internal_metric(metric)))
    order = numbered(found, "label")
    tagged = hot_safe_join(found, order, ["label"], "left").select("key", "core", F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    per_point = unique.select("key", "x").join(tagged, "key")
    per_row = hot_safe_join(rows, per_point.drop("key"), ["x"]).select(F.col("id").alias("_id"), "cluster", F.col("core").alias("is_core_sample"))
    out = df.join(per_row, F.col(f"`{id_col}`").cast("long") == F.col("_id")).drop("_id")
    return out.withColumn("is_noise", F.col("cluster") == -1)


def dbscan(df: DataFrame, id_col: str, cols, eps=0.5, min_samples=5, metric="euclidean") -> DataFrame:
    """Density clustering. A border row goes to the lowest-numbered cluster that has a core row within eps."""
    return density_labels(df, id_col, names(cols), float(eps), min_samples, metric)


def dbscan_summary(clustered: DataFrame) -> DataFrame:
    """Cluster, noise and core counts of a DBSCAN result."""
    return clustered.agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        F.sum(F.when(F.col("is_noise"), 1).otherwise(0)).alias("n_noise"),
        F.sum(F.when(F.col("is_core_sample"), 1).otherwise(0)).alias("n_core"),
    )


LINKAGES = ("ward", "complete", "average", "single")
MICRO_CLUSTERS = 256


def merge_tree(size: np.ndarray, dist: np.ndarray, linkage: str, k: int) -> np.ndarray:
    """Bottom-up merging of at most MICRO_CLUSTERS weighted items down to k groups."""
    size, dist = size.astype(float).copy(), dist.astype(float).copy()
    np.fill_diagonal(dist, np.inf)
    label, alive = np.arange(len(size)), len(size)
    while alive > k:
        i, j = np.unravel_index(np.argmin(dist), dist.shape)
        a, b = dist[i].copy(), dist[j].copy()
        if linkage == "single":
            new = np.minimum(a, b)
        elif linkage == "complete":
            new = np.maximum(a, b)
        elif linkage == "average":
            new = (size[i] * a + size[j] * b) / (size[i] + size[j])
        else:
            new = ((size[i] + size) * a + (size[j] + size) * b - size * dist[i, j]) / (size[i] + size[j] + size)
        new[~np.isfinite(a) | ~np.isfinite(b)] = np.inf
        new[[i, j]] = np.inf
        dist[i], dist[:, i] = new, new
        dist[j], dist[:, j] = np.inf, np.inf
        size[i] += size[j]
        label[label == j] = i
        alive -= 1
    return label


def agglomerative(
    df: DataFrame, id_col: str, cols, k=2, linkage="ward", metric="euclidean", distance_threshold=None, seed=42, micro=MICRO_CLUSTERS, method="exact"
) -> DataFrame:
    """All rows plus ``cluster``, numbered by smallest member id.

    ``method="exact"`` merges the rows themselves. Ward linkage, and average linkage of cosine distances, are exact at any
    size: rounds of reciprocal nearest neighbours over a table of clusters (see ``plans.linkage``). Single linkage is,
    too: its clusters at a distance cut are the connected components of the eps-graph, and for a cluster count the cut
    is found by bisection. Complete linkage, and average linkage of other distances, keep the distances of all distinct
    rows in one task and take at most ``micro`` of them. ``method="two_stage"`` merges ``micro`` K-Means groups (their
    counts and centres) at every size. The row count never chooses between methods.
    """
    if method not in ("exact", "two_stage") or (method == "two_stage" and linkage == "single"):
        raise ValueError("method must be exact, or two_stage for ward, complete and average linkage")
    cols = names(cols)
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}")
    if distance_threshold is not None and linkage != "single":
        raise ValueError("distance_threshold needs linkage='single'")
    metric = "euclidean" if linkage == "ward" else metric
    rows = checkpointed(points(df, id_col, cols, metric))
    unique = checkpointed(distinct_points(rows))
    n = unique.count()
    inner = internal_metric(metric)
    if distance_threshold is not None:
        found = _single_at(unique, to_internal(float(distance_threshold), metric), inner)
    elif linkage == "single":
        found = _single_count(unique, k, inner)
    elif method == "exact" and (linkage == "ward" or (linkage == "average" and metric == "cosine")):
        found = cut_tree(merges(unique, "ward" if linkage == "ward" else "average_squared"), unique, min(k, n))
    elif method == "two_stage":
        found = _two_stage(unique, k, linkage, inner, metric, seed, min(micro, n))
    elif n > micro:
        raise ValueError(f"exact {linkage} linkage takes up to micro={micro} distinct rows; use method='two_stage'")
    else:
        items = unique.orderBy("key").collect()  # at most ``micro`` rows
        x, w = np.array([r.x for r in items]), np.array([r.w for r in items])
        label = merge_tree(w, _start_distances(x, w, linkage, inner, metric), linkage, min(k, n))
        found = df.sparkSession.createDataFrame([(r.key, int(l)) for r, l in zip(items, label)], "key long, label long")
    first = found.groupBy("label").agg(F.min("key").alias("first"))
    order = numbered(first, "first")
    named = hot_safe_join(found, first.join(order, "first").select("label", "cluster"), ["label"]).select("key", "cluster")
    per_row = hot_safe_join(rows, unique.join(named, "key").select("x", "cluster"), ["x"]).select(F.col("id").alias("_id"), "cluster")
    return df.join(per_row, F.col(f"`{id_col}`").cast("long") == F.col("_id")).drop("_id")


def _start_distances(x, w, linkage, inner, metric):
    d = distances(x, x, inner)
    if linkage == "ward":
        return d * d * 2 * np.outer(w, w) / np.add.outer(w, w)
    return d * d / 2 if metric == "cosine" else d


def _single_at(unique, eps, inner):
    dims = unique.select(F.size("x").alias("d")).first().d
    return checkpointed(cluster_points(unique, dims, eps, 1, inner).select("key", "label"))


def _single_count(unique, k, inner):
    """Bisect the cut until exactly k components are left (or the cut cannot be split further because of ties)."""
    box = unique.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    low, high = 0.0, sum(r.hi - r.lo for r in box)
    best = None
    for _ in range(60):
        cut = (low + high) / 2
        found = _single_at(unique, cut, inner)
        count = found.select("label").distinct().count()
        if count <= k:
            best, high = found, cut
        else:
            low = cut
        if count == k or high - low <= 1e-12 * high:
            break
    return best if best is not None else _single_at(unique, high, inner)


def _two_stage(unique, k, linkage, inner, metric, seed, micro):
    data = unique.select("key", "x", feature_vector(unique, ["x"]).alias("features"), F.col("w").cast("double").alias("wt")).persist()
    try:
        model = MLKMeans(k=micro, maxIter=10, seed=seed, weightCol="wt").fit(data)
        tagged = checkpointed(model.transform(data).select("key", "prediction", "wt"))
    finally:
        data.unpersist()
    sizes = {r.prediction: r.w for r in tagged.groupBy("prediction").agg(F.sum("wt").alias("w")).collect()}
    ids = sorted(sizes)
    x, w = np.array([model.clusterCenters()[i] for i in ids]), np.array([sizes[i] for i in ids])
    label = merge_tree(w, _start_distances(x, w, linkage, inner, metric), linkage, min(k, len(ids)))
    table = unique.sparkSession.createDataFrame([(int(i), int(l)) for i, l in zip(ids, label)], "prediction int, label long")
    return tagged.join(F.broadcast(table), "prediction").select("key", "label")  # one row per micro-cluster


AFFINITIES = ("rbf", "nearest_neighbors", "precomputed")


def spectral(
    df: DataFrame, id_col: str, cols=None, k=2, affinity="rbf", n_neighbors=10, gamma=1.0, seed=42, edges=None, max_iter=40, n_init=10,
    landmarks=LANDMARKS
) -> DataFrame:
    """Graph clustering: k leading eigenvectors of a similarity graph, then K-Means on them; all rows plus ``cluster``,
    numbered by smallest member id. Rows without any link get -1.

    ``rbf`` links all rows with weight exp(-gamma d^2), by Nystroem extension from ``landmarks`` rows (exact if there are no
    more different ones); ``nearest_neighbors`` links each row to its nearest rows; ``precomputed`` takes an edge table
    (src, dst, weight).
    """
    if affinity not in AFFINITIES:
        raise ValueError(f"affinity must be one of {AFFINITIES}")
    out = df.withColumn("_id", F.col(f"`{id_col}`").cast("long"))
    if affinity == "rbf":
        found = rbf_embedding(checkpointed(points(df, id_col, names(cols), "euclidean")), k, float(gamma), int(landmarks))
    else:
        links = _links(df, id_col, cols, affinity, n_neighbors, edges)
        if links.isEmpty():
            return out.withColumn("cluster", F.lit(-1)).drop("_id")
        found = graph_embedding(links, k, seed, max_iter)
    placed = found.select("id", array_to_vector("v").alias("features")).persist()
    try:
        best = None
        for i in range(n_init):
            m = MLKMeans(k=k, maxIter=300, seed=seed + i).fit(placed)
            best = m if best is None or m.summary.trainingCost < best.summary.trainingCost else best
        found = checkpointed(best.transform(placed).select("id", "prediction"))
    finally:
        placed.unpersist()
    first = found.groupBy("prediction").agg(F.min("id").alias("first"))  # k rows
    rank = {r.prediction: i for i, r in enumerate(sorted(first.collect(), key=lambda r: r.first))}
    number = F.create_map(*[F.lit(v) for pair in rank.items() for v in pair])[F.col("prediction")]
    named = found.select(F.col("id").alias("_id"), number.alias("cluster"))
    return out.join(named, "_id", "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1))).drop("_id")


def _links(df, id_col, cols, affinity, n_neighbors, edges) -> DataFrame:
    """(src, dst, weight), one row per linked pair."""
    if affinity == "precomputed":
        if edges is None:
            raise ValueError("affinity='precomputed' needs edges")
        links = edges.select(F.least("src", "dst").cast("long").alias("src"), F.greatest("src", "dst").cast("long").alias("dst"), F.col("weight").cast("double"))
    else:
        rows = points(df, id_col, names(cols), "euclidean")
        near = knn(rows, rows, int(n_neighbors), "euclidean").where("query != neighbor")
        links = near.select(F.least("query", "neighbor").alias("src"), F.greatest("query", "neighbor").alias("dst"), F.lit(0.5).alias("weight"))
    return checkpointed(links.groupBy("src", "dst").agg(F.sum("weight").alias("weight")).where("src <> dst AND weight > 0"))


INLINE_SEEDS = 2_000
MAX_MODES = 50_000
BANDWIDTH_SAMPLE = 1_000


def estimate_bandwidth(rows: DataFrame, quantile=0.3) -> float:
    """Mean distance to the (quantile * m)-th neighbour within a fixed-size hash sample of the rows."""
    x = np.array([r.x for r in rows.orderBy(F.xxhash64("id"), "id").limit(BANDWIDTH_SAMPLE).collect()])
    near = max(1, int(len(x) * quantile))
    return float(np.sort(distances(x, x, "euclidean"), axis=1)[:, near - 1].mean())


def shift_seeds(rows: DataFrame, seeds: np.ndarray, bandwidth: float):
    """(seed number, mean of the rows within the bandwidth, their count) of the seeds that have such rows; for a bounded
    set of seeds, in one narrow pass."""
    s, d = seeds.shape

    def part(batch):
        x = lists_to_matrix(batch.column(0))
        near = (distances(seeds, x, "euclidean") <= bandwidth).astype(float)
        return np.concatenate([(near @ x).ravel(), near.sum(axis=1)])

    sums = sum_vectors(rows.select("x"), part, s * d + s)
    count = sums[s * d :]
    hit = np.flatnonzero(count > 0)
    return hit, sums[: s * d].reshape(s, d)[hit] / count[hit, None], count[hit]


def _shift_many(cells: PivotCells, seeds: DataFrame, bandwidth: float) -> DataFrame:
    """The same step for any number of seeds (key, x): block pairs, one partial sum per seed and block."""

    def work(q: pa.Table, t: pa.Table) -> pa.Table:
        schema = pa.schema([("key", pa.int64()), ("s", pa.list_(pa.float64())), ("n", pa.float64())])
        if not q.num_rows or not t.num_rows:
            return schema.empty_table()
        near = (distances(_matrix(q), _matrix(t), "euclidean") <= bandwidth) * _ints(t, "w")[None, :].astype(float)
        sums, n = near @ _matrix(t), near.sum(axis=1)
        hit = n > 0
        return pa.table([_ints(q, "key")[hit], pa.array(list(sums[hit]), pa.list_(pa.float64())), n[hit]], schema=schema)

    found = cells.block_join(cells.route(seeds.select("key", "x"), eps=bandwidth), "key", work, "key long, s array<double>, n double")
    d = cells.pivots.shape[1]
    total = found.groupBy("key").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(d)])
    return total.select("key", F.array(*[F.col(f"s{j}") / F.col("n") for j in range(d)]).alias("m"), "n")


def bin_seeds(rows: DataFrame, bandwidth: float, min_bin_freq: int) -> DataFrame:
    """One seed per occupied bin of side ``bandwidth``."""
    bins = rows.select(F.transform("x", lambda v: F.rint(v / F.lit(bandwidth))).alias("b")).groupBy("b").count()
    return bins.where(F.col("count") >= min_bin_freq).select(F.transform("b", lambda v: v * F.lit(bandwidth)).alias("x"))


class MeanShift(Operator):
    """Flat-kernel mode seeking. Seeds are all distinct rows, or the occupied bins with ``bin_seeding``.

    Cells inside a ball enter as one sum, and only cells on its border compare rows (see ``plans.balls``). Up to
    INLINE_VALUES numbers go to every task, which then takes its share of the seeds to the top in one job. More stay
    where they are, and a round is one pass: up to INLINE_SEEDS seeds travel with the task, more run as block pairs. All
    three give the same modes."""

    def __init__(self, cols, id_col, bandwidth=0.0, bin_seeding=False, min_bin_freq=1, max_iter=300):
        super().__init__()
        self.cols, self.id_col, self.bandwidth = names(cols), id_col, float(bandwidth)
        self.bin_seeding, self.min_bin_freq, self.max_iter = bin_seeding, int(min_bin_freq), int(max_iter)

    def _fit(self, df):
        rows = checkpointed(points(df, self.id_col, self.cols, "euclidean"))
        width = self.bandwidth or estimate_bandwidth(rows)
        if width <= 0:
            raise ValueError("bandwidth must be positive")
        seeds = bin_seeds(rows, width, self.min_bin_freq) if self.bin_seeding else distinct_points(rows).select("x")
        seeds = checkpointed(seeds)
        many = seeds.count()
        if many == 0:
            raise ValueError("no bin has min_bin_freq rows")
        shape = distinct_points(rows).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
        if shape.n * shape.d <= INLINE_VALUES:
            found = modes_inline(distinct_points(rows), shape.n * shape.d, seeds, width, self.max_iter).limit(MAX_MODES + 1).collect()
            modes = self._all(found)
        elif many <= INLINE_SEEDS:
            modes = self._few(rows, np.array([r.x for r in seeds.collect()]), width)
        else:
            modes = self._many(rows, seeds, width)
        centers = _suppress(modes, width)
        return MeanShiftModel(cols=self.cols, centers=centers.tolist(), bandwidth=width, n_clusters=len(centers))

    def _few(self, rows, seeds, width):
        packs = packed(distinct_points(rows), width)
        at, count = seeds, np.ones(len(seeds))
        live = np.ones(len(seeds), dtype=bool)
        for _ in range(self.max_iter):
            open_ = np.flatnonzero(live)
            total, hits = packed_sums(packs, at[open_], width)
            count[open_], live[open_] = 0, False
            hit = hits > 0
            open_, moved, hits = open_[hit], total[hit] / hits[hit, None], hits[hit]
            gap = np.sqrt(((moved - at[open_]) ** 2).sum(axis=1))
            at[open_], count[open_], live[open_] = moved, hits, gap > 1e-3 * width
            if not live.any():
                break
        return [(c, tuple(m)) for m, c in zip(at, count) if c > 0]

    def _many(self, rows, seeds, width):
        cells = PivotCells(distinct_points(rows), "key", "euclidean")
        live = checkpointed(seeds.select(F.monotonically_increasing_id().alias("key"), "x"))
        done = None
        for _ in range(self.max_iter):
            step = live.join(_shift_many(cells, live, width), "key")
            gap = F.sqrt(F.aggregate(F.zip_with("x", "m", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v))
            step = checkpointed(step.select("key", F.col("m").alias("x"), "n", (gap <= 1e-3 * width).alias("still")))
            rest = step.where("still").select("x", "n")
            done = rest if done is None else checkpointed(done.unionByName(rest).distinct())
            # seeds that have met continue as one
            live = checkpointed(step.where("not still").groupBy("x").agg(F.min("key").alias("key")).select("key", "x"))
            if live.isEmpty():
                break
        return self._all(done.distinct().limit(MAX_MODES + 1).collect())

    @staticmethod
    def _all(found):
        if len(found) > MAX_MODES:
            raise ValueError("too many modes for this bandwidth")
        return [(r.n, tuple(r.x)) for r in found]


def _suppress(modes, width) -> np.ndarray:
    """Strongest mode first; modes within the bandwidth of a kept one are dropped."""
    left = np.array([m for _, m in sorted(set(modes), reverse=True)])
    kept = []
    while len(left):
        kept.append(left[0])
        left = left[np.sqrt(((left - left[0]) ** 2).sum(axis=1)) > width]
    return np.array(kept)


class MeanShiftModel(Fitted):
    def _transform(self, df):
        require(df, self.cols)
        centers = np.array(self.centers)

        @F.pandas_udf("int")
        def closest(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="int32")
            return pd.Series(distances(np.stack(x.to_numpy()), centers, "euclidean").argmin(axis=1).astype("int32"))

        return df.withColumn("cluster", closest(feature_array(df, self.cols))).withColumn("n_clusters", F.lit(self.n_clusters)).withColumn(
            "bandwidth", F.lit(self.bandwidth)
        )

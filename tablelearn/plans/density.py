"""Density clustering as Spark jobs.

Two exact plans share one contract, (key, x, w) distinct points in, (key, core, label) out, where ``label`` is the
smallest core key of the cluster (null = noise):

* ``grid`` for up to three dimensions: cells small enough that all rows of a cell are within eps of each other.
  A cell of at least ``min_samples`` rows is core as a whole, so dense cells are never compared row by row; links
  between cells are decided on bounding boxes of sub-cells first, and only undecided sub-cells compare rows.
* ``blocks`` for more dimensions: the pivot search of :mod:`neighbors` with counts and spanning forests per task.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .lineage import checkpointed
from .neighbors import PivotCells, eps_forest, smallest_label_within, weight_within
from .skew import hot_safe_join

GRID_DIMENSIONS = 3
SLICE_ROWS = 4_096
SUBCELLS = {1: 16, 2: 8, 3: 4}


def cluster_points(points: DataFrame, dims: int, eps: float, min_samples: int, metric: str) -> DataFrame:
    if eps <= 0:
        raise ValueError("eps must be positive")
    if dims <= GRID_DIMENSIONS:
        return _grid(points, dims, eps, min_samples, metric)
    return _blocks(points, eps, min_samples, metric)


def _blocks(points, eps, min_samples, metric):
    cells = PivotCells(points, "key", metric)
    weight = weight_within(cells, cells.rows, eps)
    tagged = checkpointed(cells.rows.join(weight, "key", "left").withColumn("core", F.coalesce("weight", F.lit(0)) >= min_samples))
    core = tagged.where("core").select("key", "x", "cell")
    labels = components(eps_forest(cells, core, eps))
    core = core.join(labels, core.key == labels.node, "left").select("key", "x", "cell", F.coalesce("comp", "key").alias("label"))
    core = checkpointed(core)
    edge = smallest_label_within(cells, tagged.where("not core"), core, eps)
    known = core.select("key", "label").unionByName(edge)
    return tagged.select("key", "core").join(known, "key", "left")


def _length(gaps: list[Column], metric: str) -> Column:
    if metric == "manhattan":
        return sum(gaps[1:], gaps[0])
    if metric == "chebyshev":
        return gaps[0] if len(gaps) == 1 else F.greatest(*gaps)
    return F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))


def _offsets(dims: int, metric: str, side: float, eps: float) -> list[tuple[int, ...]]:
    """Cell offsets whose rows can be within eps."""
    reach = int(math.ceil(eps / side)) + 1
    out = []
    for o in product(range(-reach, reach + 1), repeat=dims):
        gaps = [max(abs(v) - 1, 0) * side for v in o]
        size = {"manhattan": sum(gaps), "chebyshev": max(gaps)}.get(metric, math.sqrt(sum(g * g for g in gaps)))
        if size <= eps * (1 + 1e-9):
            out.append(o)
    return out


def _grid(points, dims, eps, min_samples, metric):
    spark = points.sparkSession
    axes = range(dims)
    side = {"manhattan": eps / dims, "chebyshev": eps}.get(metric, eps / math.sqrt(dims)) * (1 - 1e-9)
    parts = SUBCELLS[dims]
    g, x = [f"g{i}" for i in axes], [f"x{i}" for i in axes]
    rows = points.select("key", "w", *[F.col("x")[i].alias(f"x{i}") for i in axes])
    rows = rows.select("*", *[F.floor(F.col(f"x{i}") / F.lit(side)).alias(f"g{i}") for i in axes])
    rows = checkpointed(rows)
    n = rows.count()
    if n == 0:
        return spark.createDataFrame([], "key long, core boolean, label long")
    cells = checkpointed(rows.groupBy(*g).agg(F.sum("w").alias("cell_w"), F.count(F.lit(1)).alias("cell_n")))
    tagged = checkpointed(hot_safe_join(rows, cells, g, rows=n))

    def near_pairs(queries: DataFrame, cell_rows: DataFrame, targets: DataFrame, value: Column, extra=()) -> DataFrame:
        """Query rows against target rows of the surrounding cells, kept where within eps. Cells without targets
        drop out on the small cell table; a large cell is cut into hash slices."""
        moved = F.explode(F.array(*[F.struct(*[(F.col(f"g{i}") + o[i]).alias(f"g{i}") for i in axes]) for o in offsets]))
        q = queries.select(F.col("key").alias("q"), *[F.col(f"x{i}").alias(f"y{i}") for i in axes], moved.alias("t"))
        q = q.select("q", *[f"y{i}" for i in axes], *[F.col(f"t.g{i}").alias(f"g{i}") for i in axes])
        sized = cell_rows.select(*g, *extra, F.ceil(F.col("cell_n") / SLICE_ROWS).cast("int").alias("slices"))
        q = q.join(sized, g).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
        t = targets.withColumn("slice", F.pmod(F.xxhash64("key"), F.ceil(F.col("cell_n") / SLICE_ROWS)).cast("int"))
        near = _length([F.abs(F.col(f"x{i}") - F.col(f"y{i}")) for i in axes], metric) <= F.lit(eps)
        return q.join(t.select(*g, *x, "slice", "w"), [*g, "slice"]).where(near).select("q", value.alias("v"))

    offsets = _offsets(dims, metric, side, eps)
    thin = tagged.where(F.col("cell_w") < min_samples)
    if min_samples > 1:
        counts = near_pairs(thin, cells, tagged, F.col("w")).groupBy("q").agg(F.sum("v").alias("v"))
        strong = counts.where(F.col("v") >= min_samples).select(F.col("q").alias("key"), F.lit(True).alias("strong"))
        tagged = tagged.join(strong, "key", "left").withColumn("core", (F.col("cell_w") >= min_samples) | F.coalesce("strong", F.lit(False)))
        tagged = checkpointed(tagged.drop("strong"))
    else:
        tagged = tagged.withColumn("core", F.lit(True))
    core = tagged.where("core").drop("cell_w", "cell_n")
    core_cells = checkpointed(core.groupBy(*g).agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("cell_n")))
    comps = _cell_components(core, core_cells, g, x, axes, side, parts, offsets, eps, metric)
    if comps is None:
        labelled = core_cells.select(*g, "cell_n", F.col("rep").alias("label"))
    else:
        labelled = core_cells.join(comps, core_cells.rep == comps.node, "left").select(*g, "cell_n", F.coalesce("comp", "rep").alias("label"))
    labelled = checkpointed(labelled)
    core_labels = hot_safe_join(core, labelled.drop("cell_n"), g, rows=n).select("key", "label")
    if min_samples > 1:
        sized_core = hot_safe_join(core, core_cells.drop("rep"), g, rows=n)
        edge = near_pairs(tagged.where("not core"), labelled, sized_core, F.col("label"), ["label"])
        core_labels = core_labels.unionByName(edge.groupBy(F.col("q").alias("key")).agg(F.min("v").alias("label")))
    return tagged.select("key", "core").join(core_labels, "key", "left")


def _cell_components(core, core_cells, g, x, axes, side, parts, offsets, eps, metric):
    """(node, comp) over the cell representatives; two cells are linked when they hold core rows within eps."""
    sub = [f"s{i}" for i in axes]
    cut = [F.least(F.floor((F.col(f"x{i}") / F.lit(side) - F.col(f"g{i}")) * parts), F.lit(parts - 1)).cast("int").alias(f"s{i}") for i in axes]
    core = core.select("*", *cut)
    ends = [f(f"x{i}").alias(f"{k}{i}") for i in axes for k, f in (("lo", F.min), ("hi", F.max))]
    boxes = core.groupBy(*g, *sub).agg(F.count(F.lit(1)).alias("box_n"), *ends).join(core_cells.select(*g, "rep"), g)
    boxes = checkpointed(boxes)
    half = [o for o in offsets if o > tuple(0 for _ in axes)]
    if not half:
        return None
    names = [c for c in boxes.columns if c not in g]
    moved = F.explode(F.array(*[F.struct(*[(F.col(f"g{i}") + o[i]).alias(f"g{i}") for i in axes]) for o in half]))
    here = boxes.select(*[F.col(c).alias(f"p_{c}") for c in names], *[F.col(c).alias(f"p_{c}") for c in g], moved.alias("t"))
    here = here.select("*", *[F.col(f"t.{c}").alias(c) for c in g]).drop("t")
    both = here.join(boxes, g)
    zero = F.lit(0.0)
    least = _length([F.greatest(zero, F.col(f"lo{i}") - F.col(f"p_hi{i}"), F.col(f"p_lo{i}") - F.col(f"hi{i}")) for i in axes], metric)
    most = _length([F.greatest(F.col(f"hi{i}") - F.col(f"p_lo{i}"), F.col(f"p_hi{i}") - F.col(f"lo{i}")) for i in axes], metric)
    both = both.select("*", F.col("p_rep").alias("a"), F.col("rep").alias("b"), least.alias("least"), most.alias("most"))
    both = checkpointed(both.where(F.col("least") <= F.lit(eps)).drop(*[f"{p}{k}{i}" for p in ("", "p_") for k in ("lo", "hi") for i in axes]))
    sure = checkpointed(both.where(F.col("most") <= F.lit(eps)).select("a", "b").distinct())
    comps = components(sure)
    open_ = both.where(F.col("most") > F.lit(eps)).join(sure, ["a", "b"], "left_anti")
    for side_ in ("a", "b"):
        named = comps.select(F.col("node").alias(side_), F.col("comp").alias(f"c{side_}"))
        open_ = open_.join(named, side_, "left").withColumn(f"c{side_}", F.coalesce(f"c{side_}", side_))
    open_ = checkpointed(open_.where("ca != cb"))
    if open_.isEmpty():
        return comps
    slices = lambda c: F.ceil(F.col(c) / SLICE_ROWS).cast("int")
    open_ = open_.withColumn("pt", slices("p_box_n")).withColumn("nt", slices("box_n"))
    open_ = open_.withColumn("ps", F.explode(F.sequence(F.lit(0), F.col("pt") - 1))).withColumn("ns", F.explode(F.sequence(F.lit(0), F.col("nt") - 1)))
    sliced = hot_safe_join(core, boxes.select(*g, *sub, "box_n"), [*g, *sub]).withColumn("sl", F.pmod(F.xxhash64("key"), slices("box_n")).cast("int"))
    first = sliced.select(*[F.col(c).alias(f"p_{c}") for c in [*g, *sub]], F.col("sl").alias("ps"), *[F.col(c).alias(f"p_{c}") for c in x])
    second = sliced.select(*g, *sub, F.col("sl").alias("ns"), *x)
    pairs = open_.select("ca", "cb", "ps", "ns", *g, *sub, *[f"p_{c}" for c in [*g, *sub]])
    pairs = pairs.join(first, [*[f"p_{c}" for c in [*g, *sub]], "ps"]).join(second, [*g, *sub, "ns"])
    near = _length([F.abs(F.col(f"x{i}") - F.col(f"p_x{i}")) for i in axes], metric) <= F.lit(eps)
    late = components(pairs.where(near).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    late = late.select(F.col("node").alias("comp"), F.col("comp").alias("late"))
    every = comps.unionByName(late.select(F.col("comp").alias("node"), "comp")).distinct()  # cells linked only late
    return hot_safe_join(every, late, ["comp"], "left").select("node", F.coalesce("late", "comp").alias("comp"))

"""Exact order statistics and quantiles with bounded memory on any number of rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

DIRECT_ROWS = 2_000_000
BUCKETS = 16_384


def exact_quantiles(data: DataFrame, cols: list[str], marks: list[float], direct_rows: int = DIRECT_ROWS):
    """Linear-interpolated quantiles of each column. Returns ([[q per mark] per column], row count).

    Up to ``direct_rows`` rows one ``percentile`` aggregate does it. Beyond that the two neighbouring order
    statistics of each quantile are found by bucket counting (see :func:`order_statistics`).
    """
    ends = _ends(data, cols)
    n = ends["n"]
    if n == 0:
        raise ValueError("no rows to fit on")
    if n <= direct_rows:
        wanted = F.array(*[F.lit(float(m)) for m in marks])
        row = data.agg(*[F.percentile(F.col(f"`{c}`"), wanted).alias(f"q{i}") for i, c in enumerate(cols)]).first()
        return [row[f"q{i}"] for i in range(len(cols))], n
    ranks = {}
    for i, _ in enumerate(cols):
        filled = ends[f"n{i}"]
        if filled:
            ranks[i] = sorted({f(m * (filled - 1)) for m in marks for f in (math.floor, math.ceil)})
    found = order_statistics(data, cols, ranks, direct_rows, ends)
    out = []
    for i, _ in enumerate(cols):
        filled = ends[f"n{i}"]
        if not filled:
            out.append(None)
            continue
        line = []
        for m in marks:
            pos = m * (filled - 1)
            a, b = found[i, math.floor(pos)], found[i, math.ceil(pos)]
            line.append(a + (b - a) * (pos - math.floor(pos)))
        out.append(line)
    return out, n


def _ends(data, cols):
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    return data.agg(*aggs).first()


def integer_order_statistic(df: DataFrame, col: str, rank: int, buckets: int = 1024) -> int:
    """The value at the 0-based ``rank`` of an integer column, in whole-number arithmetic: rows are counted by equal
    ranges of values, and the range that holds the rank is cut again."""
    values = df.select(F.col(f"`{col}`").cast("decimal(38,0)").alias("v")).where("v IS NOT NULL")
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    low, high = int(ends["low"]), int(ends["high"])
    while low < high:
        width = -(-(high - low + 1) // buckets)
        inside = values.where((F.col("v") >= F.lit(low)) & (F.col("v") <= F.lit(high)))
        place = F.expr(f"CAST((v - CAST('{low}' AS DECIMAL(38,0))) DIV CAST('{width}' AS DECIMAL(38,0)) AS INT)")
        for bucket, many in sorted((r["b"], r["count"]) for r in inside.groupBy(place.alias("b")).count().collect()):
            if rank < many:
                break
            rank -= many
        low, high = low + bucket * width, min(high, low + (bucket + 1) * width - 1)
    return low


def order_statistics(data: DataFrame, cols: list[str], ranks: dict[int, list[int]], direct_rows=DIRECT_ROWS, ends=None):
    """{(column position, rank): value} for 0-based ranks, exact.

    Each round counts rows per equal-width bucket of every open interval (one partial aggregate, at most
    BUCKETS rows per interval come back), keeps the bucket that holds the rank, and narrows to that bucket's
    own min and max. An interval is closed when it holds one value, or few enough rows for ``percentile``.
    """
    ends = ends or _ends(data, cols)
    spans = {}  # (col, rank) -> (lo, hi, rows below lo, rows inside)
    for i, wanted in ranks.items():
        for r in wanted:
            spans[i, r] = (ends[f"lo{i}"], ends[f"hi{i}"], 0, ends[f"n{i}"])
    while True:
        wide = sorted({(i, s[0], s[1]) for (i, r), s in spans.items() if s[0] < s[1] and s[3] > direct_rows})
        if not wide:
            break
        cells = []
        for k, (i, lo, hi) in enumerate(wide):
            x = F.col(f"`{cols[i]}`")
            bucket = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(BUCKETS))), F.lit(BUCKETS - 1))
            cells.append(F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), F.struct(F.lit(k).alias("k"), bucket.alias("b"), x.alias("x"))))
        counted = (
            data.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
            .groupBy("c.k", "c.b").agg(F.count(F.lit(1)).alias("n"), F.min("c.x").alias("lo"), F.max("c.x").alias("hi"))
            .collect()
        )
        per_span = {}
        for row in sorted(counted, key=lambda r: (r.k, r.b)):
            per_span.setdefault(wide[row.k], []).append(row)
        for key, (lo, hi, below, inside) in list(spans.items()):
            rows = per_span.get((key[0], lo, hi))
            if not rows or inside <= direct_rows:
                continue
            for row in rows:
                if key[1] < below + row.n:
                    spans[key] = (row.lo, row.hi, below, row.n)
                    break
                below += row.n
    found = {key: s[0] for key, s in spans.items() if s[0] == s[1]}
    rest = [(key, s) for key, s in spans.items() if s[0] < s[1]]
    if rest:
        aggs = []
        for j, ((i, r), (lo, hi, below, inside)) in enumerate(rest):
            x = F.col(f"`{cols[i]}`")
            kept = F.when((x >= F.lit(lo)) & (x <= F.lit(hi)), x)
            share = (r - below) / (inside - 1)
            aggs.append(F.percentile(kept, F.array(F.lit(share), F.lit(min(1.0, share)))).alias(f"q{j}"))
        row = data.agg(*aggs).first()
        found.update({key: row[f"q{j}"][0] for j, (key, _) in enumerate(rest)})
    return found

"""Gaussian, multinomial and Bernoulli naive Bayes: one grouped aggregate to fit, column arithmetic to score."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..core import Fitted, Operator, with_columns
from ..functions.columns import as_double, as_matrix_columns, class_map, class_value, names, require, total
from .linear import accuracy, softmax

VARIANCE_SHARE = 1e-9


def without(x, own, n, mean, spread):
    """Mean and summed squares around it of ``n`` values, less the value ``x`` where ``own`` is 1."""
    if n < 2:
        return F.when(own == 0, F.lit(mean)), F.when(own == 0, F.lit(float(spread)))
    gap = x - F.lit(mean)
    less = F.greatest(F.lit(float(spread)) - gap * gap * F.lit(n / (n - 1)), F.lit(0.0))
    return F.lit(mean) - own * gap / F.lit(n - 1), F.when(own == 0, F.lit(float(spread))).otherwise(less)


class _NaiveBayes(Operator):
    def __init__(self, cols, target, alpha=1.0, with_score=True):
        super().__init__()
        self.cols, self.target, self.alpha, self.with_score = names(cols), target, float(alpha), with_score

    def _grouped(self, df, **aggs):
        data = as_matrix_columns(df, self.cols, keep=[self.target])
        exprs = [fn(F.col(f"`{c}`")).alias(f"{k}{i}") for k, fn in aggs.items() for i, c in enumerate(self.cols)]
        rows = data.groupBy(F.col(f"`{self.target}`").alias("c")).agg(F.count(F.lit(1)).alias("n"), *exprs).collect()
        if any(r.c is None for r in rows):
            raise ValueError(f"missing value in column {self.target}")
        rows.sort(key=lambda r: r.c)
        return rows, {k: [[float(r[f"{k}{i}"]) for i in range(len(self.cols))] for r in rows] for k in aggs}

    def _model(self, df, rows, **state):
        n = sum(r.n for r in rows)
        model = NaiveBayesModel(
            cols=self.cols, target=self.target, classes=[r.c for r in rows], class_count=[r.n for r in rows],
            class_prior=[r.n / n for r in rows], training_samples=n, accuracy=None, **state,
        )
        if self.with_score:
            model.state["accuracy"] = accuracy(model, df, self.target)
        return model


    def leave_one_out(self, df):
        """``df`` with ``prediction``: what the model fitted on all other rows says of each row.

        One grouped aggregate; then every row takes itself out of its own class's counts and statistics, as column
        arithmetic. A class without another row cannot be predicted; without any other row the prediction is null."""
        rows, stats = self._grouped(df, **self.STATISTICS)
        classes, n = [r.c for r in rows], sum(r.n for r in rows)
        xs, y = [as_double(df, c) for c in self.cols], F.col(f"`{self.target}`")
        own = [F.when(y == F.lit(c), 1).otherwise(0) for c in classes]
        data = with_columns(df, {f"_own_{i}": o for i, o in enumerate(own)})
        own = [F.col(f"_own_{i}") for i in range(len(classes))]
        data = with_columns(data, self._shared_without(xs, [r.n for r in rows], stats))
        scores = []
        for i, r in enumerate(rows):
            left = (F.lit(r.n) - own[i]).cast("double")
            score = F.log(left / F.lit(float(n - 1))) + self._score_without(xs, own[i], left, r.n, {k: v[i] for k, v in stats.items()}) if n > 1 else F.lit(None).cast("double")
            scores.append(F.when(left > 0, score))
        data = with_columns(data, {f"_joint_{i}": v for i, v in enumerate(scores)})
        joint = F.array(*[F.col(f"_joint_{i}") for i in range(len(classes))])
        best = F.array_position(joint, F.array_max(joint)) - 1
        out = data.withColumn("prediction", class_value(best, classes))
        return out.drop("_widest", *[f"_{k}_{i}" for k in ("own", "joint") for i in range(len(classes))])

    def _shared_without(self, xs, counts, stats):
        """Columns that all classes' scores use."""
        return {}


class GaussianNB(_NaiveBayes):
    STATISTICS = dict(mean=F.avg, var=F.var_pop)

    def _shared_without(self, xs, counts, stats):
        """The widest variance of a column without the row, times the share that is added to all variances."""
        n, wide = sum(counts), []
        for j, x in enumerate(xs):
            middle = sum(c * m[j] for c, m in zip(counts, stats["mean"])) / n
            spread = sum(c * (v[j] + (m[j] - middle) ** 2) for c, m, v in zip(counts, stats["mean"], stats["var"]))
            wide.append(without(x, F.lit(1), float(n), middle, spread)[1] / F.lit(max(n - 1.0, 1.0)))
        return {"_widest": F.lit(VARIANCE_SHARE) * (F.greatest(*wide) if len(wide) > 1 else wide[0])}

    def _score_without(self, xs, own, left, n, stats):
        parts = []
        for x, m, v in zip(xs, stats["mean"], stats["var"]):
            mean, spread = without(x, own, float(n), m, n * v)
            var = spread / left + F.col("_widest")
            parts.append(F.lit(-0.5) * F.log(F.lit(2 * math.pi) * var) - (x - mean) * (x - mean) / (F.lit(2.0) * var))
        return total(parts)

    def _fit(self, df):
        rows, s = self._grouped(df, **self.STATISTICS)
        n = sum(r.n for r in rows)
        widest = 0.0
        for j in range(len(self.cols)):
            middle = sum(r.n * s["mean"][i][j] for i, r in enumerate(rows)) / n
            widest = max(widest, sum(r.n * (s["var"][i][j] + (s["mean"][i][j] - middle) ** 2) for i, r in enumerate(rows)) / n)
        var = [[v + VARIANCE_SHARE * widest for v in line] for line in s["var"]]
        return self._model(df, rows, kind="gaussian", theta=s["mean"], var=var)


class MultinomialNB(_NaiveBayes):
    STATISTICS = dict(sums=lambda c: F.sum(F.when(c < 0, F.raise_error(F.lit("negative value")).cast("double")).otherwise(c)))

    def _score_without(self, xs, own, left, n, stats):
        sums = [F.lit(s + self.alpha) - own * x for x, s in zip(xs, stats["sums"])]
        return total([x * F.log(s) for x, s in zip(xs, sums)]) - total(xs) * F.log(total(sums))

    def _fit(self, df):
        rows, s = self._grouped(df, **self.STATISTICS)
        logs = []
        for line in s["sums"]:
            bottom = sum(line) + self.alpha * len(line)
            logs.append([math.log((v + self.alpha) / bottom) for v in line])
        return self._model(df, rows, kind="multinomial", log_prob=logs)


class BernoulliNB(_NaiveBayes):
    """Features count as 1 where above 0."""

    STATISTICS = dict(ones=lambda c: F.sum(F.when(c > 0, 1.0).otherwise(0.0)))

    def _score_without(self, xs, own, left, n, stats):
        parts = []
        for x, s in zip(xs, stats["ones"]):
            on = F.when(x > 0, F.lit(s + self.alpha) - own).otherwise(left + F.lit(self.alpha - s))
            parts.append(F.log(on / (left + F.lit(2 * self.alpha))))
        return total(parts)

    def _fit(self, df):
        rows, s = self._grouped(df, **self.STATISTICS)
        on = [[(v + self.alpha) / (r.n + 2 * self.alpha) for v in line] for r, line in zip(rows, s["ones"])]
        return self._model(
            df, rows, kind="bernoulli", log_prob=[[math.log(p) for p in line] for line in on],
            log_rest=[[math.log(1 - p) for p in line] for line in on],
        )


class NaiveBayesModel(Fitted):
    def _joint(self, xs, i):
        prior = F.lit(math.log(self.class_prior[i]))
        if self.kind == "gaussian":
            parts = [
                F.lit(-0.5 * math.log(2 * math.pi * v)) - (x - F.lit(m)) * (x - F.lit(m)) / F.lit(2 * v)
                for x, m, v in zip(xs, self.theta[i], self.var[i])
            ]
        elif self.kind == "multinomial":
            parts = [x * F.lit(w) for x, w in zip(xs, self.log_prob[i])]
        else:
            parts = [F.when(x > 0, F.lit(a)).otherwise(F.lit(b)) for x, a, b in zip(xs, self.log_prob[i], self.log_rest[i])]
        return prior + total(parts)

    def _transform(self, df):
        require(df, self.cols)
        xs = [as_double(df, c) for c in self.cols]
        joint = [f"_joint_{i}" for i in range(len(self.classes))]
        out = with_columns(df, {j: self._joint(xs, i) for i, j in enumerate(joint)})
        scores = [F.col(j) for j in joint]
        shares = softmax(scores) if len(scores) > 1 else [F.lit(1.0)]
        out = out.withColumn("probabilities", F.array(*shares))
        best = F.array_position(F.array(*scores), F.array_max(F.array(*scores))) - 1
        out = out.withColumn("prediction", class_value(best, self.classes))
        return out.withColumn("class_probabilities", class_map(F.col("probabilities"), self.classes)).drop(*joint)

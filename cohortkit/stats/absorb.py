"""Logistic models with one factor of very many levels (ST1, ST5).

The factor's columns are never laid out.  With one effect per level, the
information matrix is

    [ D   B ]      D: one number per level (a diagonal), B: level x term,
    [ B'  C ]      C: term x term,

so a Newton step eliminates the levels exactly: the terms' step solves the
Schur complement S = C - sum over levels of b b' / d, and each level's step
follows from its own numbers.  Spark holds the levels: one ``groupBy(level)``
gives d, b and the gradients, one more aggregate gives S, which is as small
as the other terms.  The driver sees that and nothing per level.

A level whose rows all have, or all lack, the event has an infinite effect
and says nothing about the other terms; it is left out of the fit and
reported as separated.  The baseline is the first other level by name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.recode import levels as level_list
from ..session import cut_lineage
from .glm import STEPS, TOL, _kind

LEVEL, K, N = "__level", "__k", "__n"


@dataclass
class AbsorbedFit:
    factor: str
    labels: list[str]               # of the other terms
    sources: list[tuple]            # (column, level or None) of each label
    coef: list[float]
    se: list[float]
    deviance: float
    aic: float
    iterations: int
    converged: bool
    baseline: str | None
    levels: DataFrame               # level, n, events, effect, estimate, std_error, statistic, separated

    def predict(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with the fitted probability (NULL for missing values and unknown levels)."""
        eta = F.col("__effect")
        for (col, level), b in zip(self.sources, self.coef):
            eta = eta + F.lit(b) * _value(col, level)
        lv = self.levels.select(F.col("level").alias(LEVEL), F.col("effect").alias("__effect"),
                                F.when(F.col("separated"), (F.col("events") > 0).cast("double")).alias("__sure"))
        p = F.coalesce("__sure", 1.0 / (1.0 + F.exp(-eta)))
        return (df.join(lv, F.col(self.factor).cast("string") == lv[LEVEL], "left")
                .withColumn(out, p).drop(LEVEL, "__effect", "__sure"))


def _value(col: str, level) -> Column:
    c = F.col(f"`{col}`")
    return c.cast("double") if level is None else (c == F.lit(level)).cast("double")


def fit_absorbed(df: DataFrame, outcome: str, factor: str, terms: Sequence[str] = ()) -> AbsorbedFit:
    """``glm(outcome ~ factor + terms, family = binomial)`` over complete cases, the factor by its levels' own effects."""
    cond = F.col(outcome).isNotNull() & F.col(factor).isNotNull()
    for t in terms:
        cond = cond & F.col(t).isNotNull()
    base = df.filter(cond)
    kinds = [_kind(df.schema[t].dataType) for t in terms]
    sources: list[tuple] = []
    labels: list[str] = []
    for t, kind in zip(terms, kinds):
        if kind == "factor":
            names = level_list(base, t, by="alpha")
            sources += [(t, v) for v in names[1:]]
            labels += [f"{t}{v}" for v in names[1:]]
        else:
            sources.append((t, None))
            labels.append(f"{t}TRUE" if kind == "logical" else t)
    xs = [f"__x{i}" for i in range(len(sources))]
    rows = base.select(F.col(factor).cast("string").alias(LEVEL), F.col(outcome).cast("double").alias(K),
                       F.lit(1.0).alias(N), *[_value(c, lv).alias(x) for x, (c, lv) in zip(xs, sources)])
    if "numeric" not in kinds:
        rows = rows.groupBy(LEVEL, *xs).agg(F.sum(K).alias(K), F.sum(N).alias(N))
    rows = cut_lineage(rows)
    counts = cut_lineage(rows.groupBy(LEVEL).agg(F.sum(K).alias("events"), F.sum(N).alias("n")))
    inside = (F.col("events") > 0) & (F.col("events") < F.col("n"))
    stats, beta, delta, step, solved = None, np.zeros(len(xs)), np.zeros(len(xs)), 1.0, None
    state = counts.filter(inside).select(LEVEL, F.log(F.col("events") / (F.col("n") - F.col("events"))).alias("a"))
    converged, n_steps = False, 0
    for n_steps in range(1, STEPS + 1):
        new = cut_lineage(_stats(rows, state, xs, beta + step * delta))
        like, s, r = _schur(new, len(xs))
        dev = -2.0 * like
        if solved is not None and not dev <= solved[0] + 1e-9 * (abs(solved[0]) + 1):
            step /= 2                                  # too far: half the step
            if step < 1e-6:
                break
            state = _moved(stats, xs, delta, step)
            continue
        converged = solved is not None and abs(solved[0] - dev) <= TOL * (abs(dev) + 0.1)
        stats, beta, step, solved = new, beta + step * delta, 1.0, (dev, s)
        if converged:
            break
        delta = np.linalg.solve(s, r) if len(xs) else np.zeros(0)
        state = _moved(stats, xs, delta, step)
    dev, s = solved
    cov = np.linalg.inv(s) if len(xs) else np.zeros((0, 0))
    table, baseline = _level_table(counts, stats, xs, cov)
    n_levels, whole = counts.count(), "separated"
    separated = table.filter(whole).count()
    return AbsorbedFit(factor, labels, sources, beta.tolist(), np.sqrt(np.diag(cov)).tolist(), dev,
                       dev + 2.0 * (n_levels + len(xs)), n_steps, bool(converged and separated == 0), baseline, table)


def _stats(rows: DataFrame, state: DataFrame, xs: list[str], beta: np.ndarray) -> DataFrame:
    """Per level: effect a, log likelihood, d, gradient g, and sums with the terms' columns."""
    eta = F.col("a")
    for x, b in zip(xs, beta.tolist()):
        eta = eta + F.lit(b) * F.col(x)
    p = 1.0 / (1.0 + F.exp(-F.col("__eta")))
    soft = F.greatest("__eta", F.lit(0.0)) + F.log1p(F.exp(-F.abs(F.col("__eta"))))
    live = rows.join(state, LEVEL).withColumn("__eta", eta).withColumns(
        {"__w": F.col(N) * p * (1.0 - p), "__r": F.col(K) - F.col(N) * p, "__ll": F.col(K) * F.col("__eta") - F.col(N) * soft})
    sums = [F.sum("__ll").alias("ll"), F.sum("__w").alias("d"), F.sum("__r").alias("g"), F.first("a").alias("a")]
    for i, x in enumerate(xs):
        sums += [F.sum(F.col("__w") * F.col(x)).alias(f"b{i}"), F.sum(F.col("__r") * F.col(x)).alias(f"h{i}")]
        sums += [F.sum(F.col("__w") * F.col(x) * F.col(xs[j])).alias(f"c{i}_{j}") for j in range(i, len(xs))]
    return live.groupBy(LEVEL).agg(*sums)


def _schur(stats: DataFrame, p: int) -> tuple[float, np.ndarray, np.ndarray]:
    """(log likelihood, Schur complement, its right side): one row of p x p numbers."""
    aggs = [F.sum("ll").alias("ll")]
    for i in range(p):
        aggs.append(F.sum(F.col(f"h{i}") - F.col(f"b{i}") * F.col("g") / F.col("d")).alias(f"r{i}"))
        aggs += [F.sum(F.col(f"c{i}_{j}") - F.col(f"b{i}") * F.col(f"b{j}") / F.col("d")).alias(f"s{i}_{j}") for j in range(i, p)]
    one = stats.agg(*aggs).first()
    s, r = np.zeros((p, p)), np.zeros(p)
    for i in range(p):
        r[i] = one[f"r{i}"] or 0.0
        for j in range(i, p):
            s[i, j] = s[j, i] = one[f"s{i}_{j}"] or 0.0
    return one["ll"] or 0.0, s, r


def _moved(stats: DataFrame, xs: list[str], delta: np.ndarray, step: float) -> DataFrame:
    move = F.col("g")
    for i, v in enumerate(delta.tolist()):
        move = move - F.lit(v) * F.col(f"b{i}")
    return stats.select(LEVEL, (F.col("a") + F.lit(step) * move / F.col("d")).alias("a"))


def _level_table(counts: DataFrame, stats: DataFrame, xs: list[str], cov: np.ndarray) -> tuple[DataFrame, str | None]:
    base = stats.orderBy(LEVEL).limit(1).collect()                # one row
    if not base:
        none = F.lit(None).cast("double")
        return counts.select(F.col(LEVEL).alias("level"), "n", "events", none.alias("effect"), none.alias("estimate"),
                             none.alias("std_error"), none.alias("statistic"), F.lit(True).alias("separated")), None
    b = base[0]
    u = [F.col(f"b{i}") / F.col("d") - F.lit(b[f"b{i}"] / b["d"]) for i in range(len(xs))]
    var = 1.0 / F.col("d") + F.lit(1.0 / b["d"])
    for i in range(len(xs)):
        for j in range(len(xs)):
            var = var + F.lit(float(cov[i, j])) * u[i] * u[j]
    own = F.col(LEVEL) == F.lit(b[LEVEL])
    est = F.when(~own, F.col("a") - F.lit(b["a"]))
    se = F.when(~own, F.sqrt(var))
    fitted = stats.select(LEVEL, F.col("a").alias("effect"), est.alias("estimate"), se.alias("std_error"), (est / se).alias("statistic"))
    return cut_lineage(counts.join(fitted, LEVEL, "left").select(
        F.col(LEVEL).alias("level"), "n", "events", "effect", "estimate", "std_error", "statistic",
        F.col("effect").isNull().alias("separated"))), b[LEVEL]

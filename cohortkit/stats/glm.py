"""Logistic models and odds-ratio tables (ST1, ST2, ST3, ST8, SNK5).

Models are fitted by Newton steps.  One step of any number of models on the
same frame is one Spark job: every task adds up the gradients and weighted
cross products of its rows for all models at once, a ``groupBy`` sums them,
and the driver solves the p x p systems.  A backward search fits all
candidates of a step together, and all profile limits of a table advance
together.

Rows are compressed to distinct patterns (rows ``n``, events ``k``) when
every term is logical or a factor; with a numeric term they are not, as a
continuous column leaves nothing to fold.  That is decided by the type of the
terms, never by size.  The design frame is checkpointed to the shared
folder, so the many steps do not re-read the source.

Design follows R's formula rules as the study uses them: rows with any
missing term are dropped (complete cases), logical terms enter as
``<name>TRUE``, factor terms as treatment contrasts ``<name><level>``
with the *first* level as baseline, numeric terms as they are.

A fit that has not converged, or whose standard errors blow up (separated
data), is flagged; a profile limit that cannot be found is NULL.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.recode import level_index, level_table
from ..session import cut_lineage

Z975 = 1.959963984540054        # qnorm(0.975)
INTERCEPT = "(Intercept)"
K, N = "__k", "__n"             # events and rows of a pattern
STEPS, TOL = 50, 1e-11
#: standard error beyond which data count as separated
SEPARATED_SE = 1e3
#: cells of the dense design block built at once in a task
CELLS = 1 << 20


@dataclass
class TermSpec:
    name: str
    kind: str                        # numeric | logical | factor
    column: str                      # column of the frame: a number, or the level's index
    labels: list[str]                # coefficient names
    levels: list | None = None


@dataclass
class Design:
    frame: DataFrame                 # term columns, events, rows
    outcome: str
    terms: list[TermSpec]
    n_rows: int = 0
    n_events: int = 0

    @property
    def labels(self) -> list[str]:
        return [lb for t in self.terms for lb in t.labels]

    def columns_of(self, names: Sequence[str]) -> list[int]:
        """Design columns of the named terms (0 is the intercept)."""
        out, at = [], 1
        for t in self.terms:
            if t.name in names:
                out += range(at, at + len(t.labels))
            at += len(t.labels)
        return out


@dataclass
class LogitFit:
    design: Design
    labels: list[str]                # coefficient names, intercept first
    coef: list[float | None]
    se: list[float | None]
    z: list[float | None]
    p: list[float | None]
    aic: float
    deviance: float
    null_deviance: float
    iterations: int
    aliased: list[str] = field(default_factory=list)
    intercept: bool = True
    converged: bool = True
    columns: list[int] = field(default_factory=list)     # design column of each label
    terms: list[str] = field(default_factory=list)       # terms of the model


@dataclass
class Model:
    """Free design columns, and fixed ones with their values."""
    free: list[int]
    fixed: dict[int, float] = field(default_factory=dict)
    beta: np.ndarray | None = None


@dataclass
class Solution:
    beta: np.ndarray
    gram: np.ndarray                 # of the free columns, at beta
    deviance: float
    iterations: int
    converged: bool


def _kind(dtype) -> str:
    if isinstance(dtype, T.BooleanType):
        return "logical"
    if isinstance(dtype, (T.StringType,)):
        return "factor"
    return "numeric"


def build_design(df: DataFrame, outcome: str, terms: Sequence[str],
                 levels: Mapping[str, Sequence | DataFrame] | None = None) -> Design:
    """Complete cases over ``outcome`` + ``terms``, with one column per term.
    ``levels``: a level list, or a level table, per factor; by default the
    levels sorted by name."""
    levels = dict(levels or {})
    cond = F.col(outcome).isNotNull()
    for t in terms:
        cond = cond & F.col(t).isNotNull()
    x = df.filter(cond).select(outcome, *terms)
    specs: list[TermSpec] = []
    kinds = {t: _kind(df.schema[t].dataType) for t in terms}
    for i, t in enumerate(terms):
        c = f"__t{i}"
        if kinds[t] == "factor":
            lv = levels.get(t)
            if lv is None:
                lv = level_table(df.filter(cond), t, by="alpha")
            elif not isinstance(lv, DataFrame):
                lv = df.sparkSession.createDataFrame([(v, k) for k, v in enumerate(lv, 1)], "level string, position int")
            # few rows (their names are collected below): a join by value would sort all rows of a level in one task
            x = level_index(x, t, F.broadcast(lv), c)
            # the names of this model's coefficients
            names = [r["level"] for r in lv.orderBy("position").select("level").collect()]
            specs.append(TermSpec(t, "factor", c, [f"{t}{level}" for level in names[1:]], names))
        else:
            x = x.withColumn(c, F.col(t).cast("double"))
            specs.append(TermSpec(t, kinds[t], c, [f"{t}TRUE" if kinds[t] == "logical" else t]))
    cols = [s.column for s in specs]
    y = F.col(outcome).cast("double")
    if "numeric" in kinds.values():
        x = x.select(*cols, y.alias(K), F.lit(1.0).alias(N))
    elif cols:
        x = x.groupBy(*cols).agg(F.sum(y).alias(K), F.count(F.lit(1)).cast("double").alias(N))
    else:
        x = x.agg(F.sum(y).alias(K), F.count(F.lit(1)).cast("double").alias(N))
    x = cut_lineage(x)
    n, k = x.agg(F.sum(N), F.sum(K)).first()
    return Design(x, outcome, specs, int(n or 0), int(k or 0))


def _block(cols: list[np.ndarray], kinds: list[tuple[bool, int]], a: int, z: int) -> np.ndarray:
    """Dense design rows a..z: intercept, numbers, one column per further level."""
    width = 1 + sum(w for _, w in kinds)
    x = np.zeros((z - a, width))
    x[:, 0] = 1.0
    at = 1
    for c, (factor, w) in zip(cols, kinds):
        if factor:
            v = c[a:z].astype(np.int64)
            r = np.flatnonzero(v > 0)
            x[r, at + v[r] - 1] = 1.0
        else:
            x[:, at] = c[a:z]
        at += w
    return x


def _sums(kinds: list[tuple[bool, int]], models: list[Model]):
    """Per model: (-1, -1) the log likelihood, (i, -1) the gradient, (i, j) the weighted cross products."""
    def run(batches):
        total: list[tuple] = [None] * len(models)
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(len(kinds))]
            k, n = (b.column(len(kinds) + i).to_numpy() for i in range(2))
            step = max(1, CELLS // (1 + sum(w for _, w in kinds)))
            for a in range(0, len(k), step):
                z = min(len(k), a + step)
                x = _block(cols, kinds, a, z)
                for i, m in enumerate(models):
                    eta = x[:, m.free] @ m.beta
                    for c, v in m.fixed.items():
                        eta = eta + v * x[:, c]
                    p = 0.5 * (1 + np.tanh(eta / 2))
                    like = float((k[a:z] * eta - n[a:z] * np.logaddexp(0, eta)).sum())
                    xf = x[:, m.free]
                    grad = xf.T @ (k[a:z] - n[a:z] * p)
                    gram = xf.T @ (xf * (n[a:z] * p * (1 - p))[:, None])
                    t = total[i]
                    total[i] = (like, grad, gram) if t is None else (t[0] + like, t[1] + grad, t[2] + gram)
        for i, t in enumerate(total):
            if t is None:
                continue
            r, c = np.nonzero(t[2])
            up = c >= r
            rows = np.concatenate([[-1], np.arange(len(t[1])), r[up]])
            cols_ = np.concatenate([np.full(1 + len(t[1]), -1), c[up]])
            vals = np.concatenate([[t[0]], t[1], t[2][r[up], c[up]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), i), pa.int32()), pa.array(rows, pa.int32()),
                                              pa.array(cols_, pa.int32()), pa.array(vals, pa.float64())],
                                             ["m", "i", "j", "v"])
    return run


def _evaluate(design: Design, models: list[Model]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """(deviance, gradient, Gram matrix) of each model at its beta: one job."""
    kinds = [(t.kind == "factor", len(t.labels)) for t in design.terms]
    frame = design.frame.select(*[t.column for t in design.terms], K, N)
    rows = (frame.mapInArrow(_sums(kinds, models), "m int, i int, j int, v double")
            .groupBy("m", "i", "j").agg(F.sum("v").alias("v")).collect())     # p x p numbers per model
    out = [[0.0, np.zeros(len(m.free)), np.zeros((len(m.free), len(m.free)))] for m in models]
    for r in rows:
        o = out[r["m"]]
        if r["i"] < 0:
            o[0] = -2.0 * r["v"]
        elif r["j"] < 0:
            o[1][r["i"]] = r["v"]
        else:
            o[2][r["i"], r["j"]] = o[2][r["j"], r["i"]] = r["v"]
    return [tuple(o) for o in out]


def solve_models(design: Design, models: list[Model]) -> list[Solution]:
    """Newton steps for all models at once, with halving where the deviance rises."""
    for m in models:
        if m.beta is None:
            m.beta = np.zeros(len(m.free))
    out: list[Solution | None] = [None] * len(models)
    best: list[tuple | None] = [None] * len(models)        # (beta, deviance, gradient, gram)
    todo = list(range(len(models)))
    for step in range(STEPS):
        got = _evaluate(design, [models[i] for i in todo])
        nxt = []
        for i, (dev, grad, gram) in zip(todo, got):
            m, old = models[i], best[i]
            if old is not None and not dev <= old[1] + 1e-9 * (abs(old[1]) + 1):
                m.beta = 0.5 * (m.beta + old[0])            # too far: half the step
                if np.allclose(m.beta, old[0], rtol=1e-14, atol=1e-14):
                    out[i] = Solution(old[0], old[3], old[1], step, True)
                else:
                    nxt.append(i)
                continue
            settled = old is not None and abs(old[1] - dev) <= TOL * (abs(dev) + 0.1)
            best[i] = (m.beta, dev, grad, gram)
            if settled or not m.free:
                out[i] = Solution(m.beta, gram, dev, step, True)
                continue
            try:
                delta = np.linalg.solve(gram, grad)
            except np.linalg.LinAlgError:
                out[i] = Solution(m.beta, gram, dev, step, False)
                continue
            m.beta = m.beta + delta
            nxt.append(i)
        todo = nxt
        if not todo:
            break
    for i in todo:
        out[i] = Solution(best[i][0], best[i][3], best[i][1], STEPS, False)
    return out


def aliased_columns(design: Design, columns: Sequence[int], tol: float = 1e-7) -> list[int]:
    """Design columns that are linear combinations of earlier ones (R reports
    them as NA): a rank check on one p x p cross-product matrix."""
    _, _, g = _evaluate(design, [Model(list(columns), beta=np.zeros(len(columns)))])[0]
    kept: list[int] = []
    out = []
    for j in range(len(columns)):
        resid = g[j, j]
        if kept:
            resid -= g[kept, j] @ np.linalg.solve(g[np.ix_(kept, kept)], g[kept, j])
        if resid <= tol * max(g[j, j], 1e-300):
            out.append(columns[j])
        else:
            kept.append(j)
    return out


def _table(design: Design, columns: list[int], aliased: list[int], s: Solution, use: list[int]) -> LogitFit:
    names = [INTERCEPT, *design.labels]
    try:
        cov = np.linalg.inv(s.gram) if len(use) else np.zeros((0, 0))
        se = np.sqrt(np.diag(cov))
    except np.linalg.LinAlgError:
        se = np.full(len(use), np.inf)
    at = {c: i for i, c in enumerate(use)}
    coef = [float(s.beta[at[c]]) if c in at else None for c in columns]
    ses = [float(se[at[c]]) if c in at else None for c in columns]
    zs = [None if b is None else b / e if e else math.inf for b, e in zip(coef, ses)]
    ps = [None if z is None else math.erfc(abs(z) / math.sqrt(2.0)) for z in zs]
    n, k = design.n_rows, design.n_events
    null = -2.0 * ((k * math.log(k / n) if k else 0.0) + ((n - k) * math.log(1 - k / n) if n > k else 0.0)) if n else 0.0
    ok = s.converged and all(e is None or (math.isfinite(e) and e < SEPARATED_SE) for e in ses)
    return LogitFit(design, [names[c] for c in columns], coef, ses, zs, ps, s.deviance + 2.0 * len(use), s.deviance,
                    null, s.iterations, [names[c] for c in aliased], 0 in columns, ok, columns,
                    [t.name for t in design.terms if set(design.columns_of([t.name])) <= set(columns)])


def fit_many(design: Design, choices: Sequence[Sequence[str]], aliased: Sequence[int] = (),
             start: Mapping[int, float] | None = None) -> list[LogitFit]:
    """One model (with intercept) per list of term names, all fitted together;
    ``start``: coefficients by design column to begin the steps at."""
    columns = [[0, *design.columns_of(names)] for names in choices]
    use = [[c for c in cols if c not in aliased] for cols in columns]
    begin = [np.array([start.get(c, 0.0) for c in u]) if start else None for u in use]
    sols = solve_models(design, [Model(u, beta=b) for u, b in zip(use, begin)])
    return [_table(design, c, [a for a in aliased if a in c], s, u) for c, s, u in zip(columns, sols, use)]


def fit(design: Design, intercept: bool = True) -> LogitFit:
    """ST1: binomial GLM on the design."""
    columns = [*([0] if intercept else []), *design.columns_of([t.name for t in design.terms])]
    aliased = aliased_columns(design, columns) if len(columns) > 1 else []
    use = [c for c in columns if c not in aliased]
    return _table(design, columns, aliased, solve_models(design, [Model(use)])[0], use)


def logit(df: DataFrame, outcome: str, terms: Sequence[str],
          levels: Mapping[str, Sequence | DataFrame] | None = None) -> LogitFit:
    """``glm(outcome ~ terms, family = binomial)``."""
    return fit(build_design(df, outcome, terms, levels))


# --- profile-likelihood limits (ST3) -----------------------------------------

@dataclass
class _Search:
    """One limit: the value where the signed root of the deviance rise reaches ``target``."""
    index: int
    target: float
    at: float                        # value to try next
    lo: tuple[float, float]          # (value, root) on the near side
    hi: tuple[float, float] | None = None
    found: float | None = None

    def take(self, root: float, tol: float) -> bool:
        """Use the root found at ``at``; True while more values are to be tried."""
        sign = math.copysign(1.0, self.target)
        if abs(root - self.target) < tol:
            self.found = self.at
            return False
        if (root - self.target) * sign < 0:
            near = self.lo
            self.lo = (self.at, root)
            if self.hi is None:
                self.at = self.at + 2.0 * (self.at - near[0])
                return math.isfinite(self.at) and abs(self.at) < 1e6
        else:
            self.hi = (self.at, root)
        (a, ra), (b, rb) = self.lo, self.hi
        if abs(b - a) <= 1e-12 * max(1.0, abs(a)):
            self.found = 0.5 * (a + b)
            return False
        at = a + (self.target - ra) * (b - a) / (rb - ra) if rb != ra else 0.5 * (a + b)
        width = abs(b - a)
        inside = min(a, b) + 1e-3 * width < at < max(a, b) - 1e-3 * width
        self.at = at if inside else min(max(at, min(a, b) + 1e-3 * width), max(a, b) - 1e-3 * width)
        return True


def profile_limits(lf: LogitFit, level: float = 0.95, tol: float = 1e-8, rounds: int = 60) -> list[tuple]:
    """Profile-likelihood limits of every coefficient: the values where the
    signed root of the deviance rise reaches -z and +z.  All limits advance
    together: each round fits the constrained models of all open searches.
    A limit that is not reached (separated data, or after ``rounds``) is None."""
    z = Z975 if abs(level - 0.95) < 1e-12 else _qnorm(0.5 + level / 2.0)
    use = [c for c, b in zip(lf.columns, lf.coef) if b is not None]
    beta = {c: b for c, b in zip(lf.columns, lf.coef) if b is not None}
    open_ = []
    for i, (b, se) in enumerate(zip(lf.coef, lf.se)):
        if b is not None and se is not None and math.isfinite(se) and se < SEPARATED_SE:
            open_ += [_Search(i, s * z, b + s * z * se, (b, 0.0)) for s in (-1.0, 1.0)]
    every = list(open_)
    warm: dict[int, np.ndarray] = {}
    for _ in range(rounds):
        if not open_:
            break
        models = []
        for s in open_:
            col = lf.columns[s.index]
            rest = [c for c in use if c != col]
            start = warm.get(id(s))
            models.append(Model(rest, {col: s.at}, start if start is not None else np.array([beta[c] for c in rest])))
        left = []
        for s, sol in zip(open_, solve_models(lf.design, models)):
            warm[id(s)] = sol.beta
            rise = max(sol.deviance - lf.deviance, 0.0)
            root = math.copysign(math.sqrt(rise), s.at - beta[lf.columns[s.index]])
            if sol.converged and s.take(root, tol):
                left.append(s)
        open_ = left
    out: list[list] = [[None, None] for _ in lf.coef]
    for s in every:
        out[s.index][s.target > 0] = s.found
    return [tuple(o) for o in out]


def _qnorm(p: float) -> float:
    # quantile of the standard normal by bisection on its CDF (math.erfc)
    lo, hi = -10.0, 10.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if 0.5 * math.erfc(-mid / math.sqrt(2.0)) < p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def or_table(lf: LogitFit, spark=None, exponentiate: bool = True, conf: str = "profile",
             level: float = 0.95, digits: int | None = 3, p_value: bool = True) -> DataFrame:
    """ST2 + SNK5: one row per coefficient -- term, estimate, std_error,
    statistic, p_value, conf_low, conf_high, converged.  ``exponentiate``
    turns the estimate and the limits into odds ratios (not the standard
    error).  ``conf``: ``"profile"`` (likelihood-profile limits, the tidy
    default for GLMs) or ``"wald"`` (estimate +- z * SE, cheap).  Numbers
    are rounded to ``digits``.  Aliased terms have NULL numbers."""
    spark = spark or lf.design.frame.sparkSession
    z = Z975 if abs(level - 0.95) < 1e-12 else _qnorm(0.5 + level / 2.0)
    if conf == "wald":
        limits = [(None, None) if b is None else (b - z * se, b + z * se) for b, se in zip(lf.coef, lf.se)]
    else:
        limits = profile_limits(lf, level)

    def number(v, exp=False):
        if v is None:
            return None
        try:
            v = math.exp(v) if exp else v
        except OverflowError:
            v = math.inf
        return v if digits is None or not math.isfinite(v) else float(round(v, digits))

    rows = [(term, number(b, exponentiate), number(se), number(st), number(pv), number(lo, exponentiate),
             number(hi, exponentiate), lf.converged)
            for term, b, se, st, pv, (lo, hi) in zip(lf.labels, lf.coef, lf.se, lf.z, lf.p, limits)]
    schema = ("term string, estimate double, std_error double, statistic double, p_value double, "
              "conf_low double, conf_high double, converged boolean")
    df = spark.createDataFrame(rows, schema)
    return df if p_value else df.drop("p_value")

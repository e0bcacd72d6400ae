"""Backward term selection by AIC (ST4).

Whole terms are dropped (a factor's dummies leave together).  The row set is
fixed once, as complete cases over *all* starting terms, so every AIC in the
search is computed on the same rows and the comparison is valid.  The
candidates of a step are fitted together, one job per Newton step for all of
them; the driver only keeps the list of terms still in the model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from .glm import Design, LogitFit, build_design, fit, fit_many


def backward_aic(design: Design, trace: list | None = None) -> LogitFit:
    """Start from every term of ``design``; at each step drop the term whose
    removal gives the lowest AIC, while that AIC is below the current one
    (ties keep the current model, as stepAIC does)."""
    current = fit(design)
    # columns that repeat others in the full model stay out of every candidate
    labels = ["(Intercept)", *design.labels]
    aliased = [labels.index(a) for a in current.aliased]
    names = [t.name for t in design.terms]
    while names:
        # a candidate begins at the current coefficients, without the dropped term's
        start = {c: b for c, b in zip(current.columns, current.coef) if b is not None} if current.converged else None
        cands = fit_many(design, [[n for n in names if n != t] for t in names], aliased, start)
        if trace is not None:
            trace += [(tuple(names), t, c.aic) for t, c in zip(names, cands)]
        at = min(range(len(names)), key=lambda i: cands[i].aic)
        if cands[at].aic >= current.aic - 1e-12:
            break
        current = cands[at]
        names = [n for i, n in enumerate(names) if i != at]
    return current


def stepwise(df: DataFrame, outcome: str, terms: Sequence[str],
             levels: Mapping[str, Sequence | DataFrame] | None = None) -> LogitFit:
    """``stepAIC(glm(outcome ~ terms), direction = "backward")``."""
    return backward_aic(build_design(df, outcome, terms, levels))

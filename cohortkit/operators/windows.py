"""Time-bounded fact extraction (JN8, FLT7).

``events_around``: facts of the same key whose time lies in
``[anchor - before, anchor + after]`` of *some* anchor, each fact once.

The join is an equi join on ``(key, day bucket)`` plus the exact range test.
Anchors of a key that lie in one cell of the window's own length have windows
that overlap in a chain, so their union is one window from the first to the
last of them: one aggregate by (key, cell) leaves at most one window per cell,
however many anchors a key has there, without gathering them.  Every window
is copied to the (at most a few) day buckets it touches; every fact has
exactly one bucket.  So:

* a key that holds a third of all facts is spread over its days instead of
  landing in one task (and AQE's skew split handles a hot key-day);
* the join is a left-semi join from the facts side: a fact inside several
  anchors' windows is emitted once, without a DISTINCT shuffle afterwards;
* no pairs beyond the (key, day) neighbourhood are ever formed.

``events_before``: facts joined to their encounter with a time bound from the
encounter (``<`` or ``<=``; a NULL bound drops the fact).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import MICROS_PER_DAY
from .predicates import before as bound_pred


def _micros(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def events_around(facts: DataFrame, anchors: DataFrame, keys: Sequence[str] | str,
                  fact_time: str, anchor_time: str, before_days: float, after_days: float,
                  bucket_days: float = 1.0) -> DataFrame:
    """JN8.  Returns the rows of ``facts`` (all its columns) that fall in the
    closed window of at least one anchor with the same ``keys``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    width = int(bucket_days * MICROS_PER_DAY)
    lo_off = int(round(before_days * MICROS_PER_DAY))
    hi_off = int(round(after_days * MICROS_PER_DAY))

    cell = max(1, lo_off + hi_off)
    a = anchors.select(*[F.col(k).alias(f"__a_{k}") for k in keys], _micros(anchor_time).alias("__at"))
    a = (a.filter(F.col("__at").isNotNull()).groupBy(*[f"__a_{k}" for k in keys], F.floor(F.col("__at") / cell).alias("__cell"))
         .agg((F.min("__at") - F.lit(lo_off)).alias("__lo"), (F.max("__at") + F.lit(hi_off)).alias("__hi")).drop("__cell"))
    a = a.withColumn("__b", F.explode(F.sequence(F.floor(F.col("__lo") / width), F.floor(F.col("__hi") / width))))

    f = facts.withColumn("__ft", _micros(fact_time)).withColumn("__b", F.floor(F.col("__ft") / width))
    cond = [f[k] == a[f"__a_{k}"] for k in keys] + [
        f["__b"] == a["__b"], f["__ft"] >= a["__lo"], f["__ft"] <= a["__hi"]]
    return f.join(a, cond, "left_semi").drop("__ft", "__b")


def events_before(facts: DataFrame, encounters: DataFrame, keys: Sequence[str] | str,
                  fact_time: str, bound_col: str, strict: bool,
                  carry: Sequence[str] = ()) -> DataFrame:
    """FLT7 + JN7: facts of the encounter (joined on all ``keys``) up to the
    encounter's bound; ``carry`` further encounter columns along."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    e = encounters.select(*keys, F.col(bound_col).alias("__bound"), *carry)
    return (facts.join(e, keys, "inner")
            .filter(bound_pred(fact_time, "__bound", strict))
            .drop("__bound"))

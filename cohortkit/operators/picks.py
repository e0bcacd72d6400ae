"""First-value picks (AGG2, WIN1, WIN2).

``max_at_first``: per key, the maximum value among the rows at the earliest
time (``MAX(v) KEEP (DENSE_RANK FIRST ORDER BY t)``).  Written as one
aggregate over ``struct(-t, v)``: it has a map-side partial step, so a key
holding a third of all rows is folded to one row per map task before the
shuffle.  Ties at the earliest time take the larger value; a NULL value only
wins when every tied value is NULL; rows with a NULL time come last.

``first_by``: per key, the whole first row by an explicit order (ties broken
by the caller's further order columns; NULL times last).  ``row_number() = 1``
is planned with a WindowGroupLimit before and after the shuffle, so a hot key
also sends at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _order_number(df: DataFrame, col: str) -> Column:
    typ = df.schema[col].dataType
    c = F.col(col)
    if isinstance(typ, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(typ, T.DateType):
        return F.unix_date(c)
    return c


def max_at_first(df: DataFrame, keys: Sequence[str] | str, order_col: str, value_col: str,
                 out: str | None = None) -> DataFrame:
    """AGG2.  Returns ``keys + [out]``, one row per key present in ``df``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = out or value_col
    packed = F.struct((-_order_number(df, order_col)).alias("t"), F.col(value_col).alias("v"))
    return df.groupBy(*keys).agg(F.max(packed).getField("v").alias(out))


def first_by(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column],
             nulls_last: bool = True) -> DataFrame:
    """WIN1/WIN2.  Whole first row per key by ``order`` (ascending)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = []
    for o in order:
        c = F.col(o) if isinstance(o, str) else o
        cols.append(c.asc_nulls_last() if nulls_last else c.asc_nulls_first())
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def first_value(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str | Column],
                value_col: str, out: str) -> DataFrame:
    """``first_by`` then keep only the key and one value column."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return first_by(df, keys, order).select(*keys, F.col(value_col).alias(out))


def max_at_first_many(df: DataFrame, keys: Sequence[str] | str, order_col: str,
                      measures: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Several AGG2 picks in one aggregate (one shuffle instead of one per
    measure): ``measures = {out: (value_col, row_condition or None)}``.
    A measure whose condition holds for no row of a key is NULL."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    t = -_order_number(df, order_col)
    aggs = []
    for out, (value_col, cond) in measures.items():
        packed = F.struct(t.alias("t"), F.col(value_col).alias("v"))
        if cond is not None:
            packed = F.when(cond, packed)
        aggs.append(F.max(packed).getField("v").alias(out))
    return df.groupBy(*keys).agg(*aggs)


def first_value_many(df: DataFrame, keys: Sequence[str] | str, order: Sequence[str],
                     measures: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Several WIN1 picks of one value each, in one aggregate:
    ``measures = {out: (value_col, row_condition or None)}``; the value of the
    first row by ``order`` (NULL order values last) among the rows meeting
    the condition.  ``min(struct(...))`` has a partial map-side step, so hot
    keys are folded before the shuffle."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    parts = []
    for i, o in enumerate(order):
        parts += [F.col(o).isNull().alias(f"n{i}"), F.col(o).alias(f"o{i}")]
    aggs = []
    for out, (value_col, cond) in measures.items():
        packed = F.struct(*parts, F.col(value_col).alias("v"))
        if cond is not None:
            packed = F.when(cond, packed)
        aggs.append(F.min(packed).getField("v").alias(out))
    return df.groupBy(*keys).agg(*aggs)

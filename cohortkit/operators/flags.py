"""History flags and pivots (AGG3, AGG4, AGG5, JN6, PRJ6).

The tidy scripts build each flag with its own filter + DISTINCT and then
chain full outer joins on the id.  Here every flag of one source is a
``bool_or`` in a *single* ``groupBy`` (one shuffle, map-side partial
aggregation, so a key with a third of all rows is folded early), and the
result is left-joined to the base id list and filled with FALSE.  The chained
full-join form is kept (``full_join_chain``) for sources that are not all
keyed by the base ids.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fill_false(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Coalesce logical columns to FALSE (PRJ6 + SC9).  By default every
    BooleanType column of the schema."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in cols})


def pattern_flags(df: DataFrame, key: str | Sequence[str], code_col: str,
                  patterns: Mapping[str, str]) -> DataFrame:
    """AGG3: one logical column per ``{flag: regex}`` -- any code of the key
    matches (unanchored, like ``str_detect``).  Only keys with at least one
    matching code get a row (as the union of the per-flag filtered id lists
    would); non-matching rows are dropped before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    c = F.col(code_col)
    hit = None
    for p in patterns.values():
        hit = c.rlike(p) if hit is None else hit | c.rlike(p)
    return df.filter(hit).groupBy(*keys).agg(*[F.bool_or(c.rlike(p)).alias(f) for f, p in patterns.items()])


def value_flags(df: DataFrame, key: str | Sequence[str], name_col: str, names: Sequence[str]) -> DataFrame:
    """AGG5 (``spread`` of distinct (id, name) pairs to TRUE columns): one
    column per requested name, always present, so the schema does not depend
    on the data.  Rows whose name is not requested are filtered before the
    shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    c = F.col(name_col)
    return (df.filter(c.isin(*names))
            .groupBy(*keys).agg(*[F.bool_or(c == F.lit(n)).alias(n) for n in names]))


def attach_flags(base: DataFrame, flags: DataFrame, key: str | Sequence[str],
                 how: str = "left") -> DataFrame:
    """JN6 one-shuffle form: base ids joined to the flag table on the merged
    key, FALSE where an id has no flag row.  ``how="full"`` also keeps ids
    that only the flag table has (as the tidy chain of full joins does)."""
    keys = [key] if isinstance(key, str) else list(key)
    names = [c for c in flags.columns if c not in keys]
    return fill_false(base.join(flags, keys, how), names)


def full_join_chain(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """JN6 literal form: chained full outer joins on the merged key, then FALSE
    for missing logical values."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full")
    return fill_false(out)


def prefix_conditions(codes: DataFrame, code_col: str, conditions: DataFrame, lengths: Iterable[int] | None = None,
                      condition_col: str = "condition", prefix_col: str = "prefix") -> DataFrame:
    """AGG4: map each code to the named condition groups whose prefix it starts
    with.  The prefixes of each *different* code are generated and equi-joined
    -- no nested-loop ``startswith`` join -- and the code's conditions then
    reach its rows by an equi-join on the code, so facts are neither multiplied
    by prefixes nor shuffled by them.  Without ``lengths`` a prefix may have any
    length (an empty one holds for every code that is not NULL); with
    ``lengths`` only those are generated, and a prefix of another length raises
    an error when the query runs.
    Returns the code rows x matching conditions (codes with no condition drop
    out)."""
    p = F.col(prefix_col)
    if lengths is None:
        sizes = F.sequence(F.lit(0), F.length("__code"))
    else:
        lengths = sorted(set(lengths))
        unnamed = F.raise_error(F.concat(F.lit(f"prefix of a length not in {lengths}: "), p))
        p = F.when(~F.length(p).isin(lengths), unnamed).otherwise(p)
        sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("__code"))
    cond = conditions.select(p.alias("__prefix"), F.col(condition_col))
    each = codes.select(F.col(code_col).alias("__code")).filter(F.col("__code").isNotNull()).distinct()
    each = each.withColumn("__len", F.explode(sizes)).withColumn("__prefix", F.expr("substring(__code, 1, __len)"))
    held = each.join(cond, "__prefix").select("__code", condition_col)
    return codes.join(held, codes[code_col] == held["__code"]).drop("__code")


def condition_flags(coded: DataFrame, key: str | Sequence[str], condition_col: str,
                    names: Sequence[str]) -> DataFrame:
    """Per key, one logical column per condition name (pivot with a fixed
    list of names, so absent conditions still get a column)."""
    return value_flags(coded, key, condition_col, names)


def any_of(cols: Sequence[str]) -> Column:
    """Logical OR of flag columns under three-valued logic (SC16)."""
    out = F.col(cols[0])
    for c in cols[1:]:
        out = out | F.col(c)
    return out

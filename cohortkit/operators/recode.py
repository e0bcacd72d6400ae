"""Categorical encoding (CAT1-CAT4, AGG6).

Levels are a table (``groupBy().count()``) that may have any number of rows:
their order comes from a parallel numbering and their index reaches the data
by a join.  A list of levels is made on the driver only for the dummy columns
and coefficients of one model, which the model's solver bounds.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import positions


def level_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG6: (level, n) of the non-missing values."""
    return df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def level_table(df: DataFrame, col: str, by: str = "freq", first: str | None = None) -> DataFrame:
    """(level, n, position): levels with their position (1 = baseline).

    ``by="freq"``: most frequent first, ties by name (CAT2); ``by="alpha"``:
    sorted by name (CAT1).  ``first`` moves one level to position 1 (CAT3).
    """
    order = [F.col("n").desc(), F.col("level").asc()] if by == "freq" else [F.col("level").asc()]
    if first is not None:
        order = [F.when(F.col("level") == F.lit(first), 0).otherwise(1).asc()] + order
    return positions(level_counts(df, col), order, out="position").withColumn("position", F.col("position").cast("int"))


def level_tables(df: DataFrame, cols: Sequence[str], first: Mapping[str, str] | None = None) -> DataFrame:
    """(column_name, level, n, position) of several columns in one pass: one
    unpivoted count, one numbering over (column, count), and the column's first
    number taken off.  By frequency, ties by name; ``first``: level moved to
    position 1, by column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("level")) for c in cols])
    counts = (df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("level").isNotNull())
              .groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n")))
    moved = F.lit(1)
    for c, lv in (first or {}).items():
        moved = F.when((F.col("column_name") == c) & (F.col("level") == lv), 0).otherwise(moved)
    every = positions(counts, [F.col("column_name"), moved.asc(), F.col("n").desc(), F.col("level")], out="rn")
    start = every.groupBy("column_name").agg(F.min("rn").alias("lo"))              # one row per column
    return every.join(F.broadcast(start), "column_name").select(
        "column_name", "level", "n", (F.col("rn") - F.col("lo") + 1).cast("int").alias("position"))


def level_index(df: DataFrame, col: str, table: DataFrame, out: str) -> DataFrame:
    """``df`` with the 0-based level index of ``col`` (0 = baseline); rows
    whose value is no level of ``table`` drop out, as missing factor values do."""
    t = table.select(F.col("level").alias("__level"), (F.col("position") - 1).cast("int").alias(out))
    return df.join(t, df[col] == t["__level"]).drop("__level")


def levels(df: DataFrame, col: str, by: str = "freq", first: str | None = None) -> list:
    """Ordered level list, for a caller that needs the names on the driver."""
    return [r["level"] for r in level_table(df, col, by, first).orderBy("position").collect()]


def dummy_name(col: str, level) -> str:
    return f"{col}_{re.sub(r'[^0-9A-Za-z]+', '_', str(level))}"


def dummies(df: DataFrame, col: str, level_list: Sequence, keep: bool = False,
            names: Sequence[str] | None = None) -> DataFrame:
    """CAT4: treatment contrasts, first level is the baseline -- one 0/1
    column per level 2..k (NULL stays NULL).  Unlike ``OneHotEncoder``'s
    default, the *first* level is the one dropped."""
    c = F.col(col)
    names = list(names) if names is not None else [dummy_name(col, lv) for lv in level_list[1:]]
    out = df.withColumns({n: F.when(c.isNull(), F.lit(None)).when(c == F.lit(lv), 1).otherwise(0).cast("int")
                          for n, lv in zip(names, level_list[1:])})
    return out if keep else out.drop(col)

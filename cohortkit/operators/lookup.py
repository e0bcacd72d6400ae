"""Joins to small dimensions (JN9).

No broadcast hint is given on a table that could grow: the planner broadcasts
a side whose size statistics or run-time size (adaptive execution) are under
its threshold and shuffles it otherwise, so building a plan runs no job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def literal_table(spark, rows, schema) -> DataFrame:
    """A small table given by the caller (code set, condition map).  Its size is
    fixed by the caller's list, so it is safe to broadcast."""
    return F.broadcast(spark.createDataFrame(list(rows), schema))


def attach_display(df: DataFrame, codes: DataFrame, col: str | Column, out: str,
                   code_col: str = "code", display_col: str = "display") -> DataFrame:
    """Left join one code column (or code expression) to its display text
    (JN9).  Call once per column."""
    lk = codes.select(F.col(code_col).alias("__lk"), F.col(display_col).alias(out))
    code = F.col(col) if isinstance(col, str) else col
    return df.withColumn("__code", code.cast("long")).join(lk, F.col("__code") == F.col("__lk"), "left").drop("__code", "__lk")


def attach_alias(df: DataFrame, aliases: DataFrame, alias_type: str, out: str = "fin",
                 key: str = "encntr_id", how: str = "left") -> DataFrame:
    """Outside identifier of one type for every row (JN10).  An encounter with
    several aliases of the type gives a row for each, one without keeps NULL."""
    a = aliases.filter(F.col("alias_type_cd") == F.lit(alias_type)).select(key, F.col("alias").alias(out))
    return df.join(a, key, how)

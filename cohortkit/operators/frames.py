"""Frame-level reshaping (PRJ4, PRJ5, SET2, AGG7)."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_first(df: DataFrame, key: str, drop: Sequence[str] = ()) -> DataFrame:
    """Key column first, then every other column, surrogate ids dropped (PRJ4)."""
    rest = [c for c in df.columns if c != key and c not in drop]
    return df.select(key, *rest)


def map_columns(df: DataFrame, cols: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one column function to the named columns (PRJ5)."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def map_type(df: DataFrame, dtype: type, fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one column function to every column of a type (PRJ6)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, dtype)]
    return map_columns(df, cols, fn)


def stack_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack rows by column name; a column missing from a frame is NULL (SET2)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


#: bins of one refinement
BINS = 1 << 12


def rank_values(df: DataFrame, ranks: Mapping[str, Sequence[int]], bounds: Mapping[str, tuple[float, float]]) -> dict:
    """(column, rank) -> the value at that rank (from 1) of the sorted non-missing values, for any number of
    columns and ranks at once.

    Every round is one scan: the interval a rank lies in is cut into ``BINS`` bins, one aggregate counts them (with
    their least and greatest value) for all open intervals of all columns, and the bin that holds the rank is the
    next interval, from its least to its greatest value.  It ends when these are equal.  A round divides the interval
    by thousands, so two or three scans settle most columns.  ``bounds``: least and greatest value of each column.
    """
    spark = df.sparkSession
    cols = sorted(ranks)
    found: dict = {}
    open_: dict = {}                         # (column, low, high) -> [(rank asked for, rank inside)]
    for c in cols:
        lo, hi = bounds[c]
        if lo == hi:
            found.update({(c, r): lo for r in ranks[c]})
        else:
            open_[c, lo, hi] = [(r, r) for r in sorted(set(ranks[c]))]
    each = F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("double").alias("v")) for c in cols])
    while open_:
        keys = list(open_)
        parts = spark.createDataFrame([(i, c, lo, hi) for i, (c, lo, hi) in enumerate(keys)], "i int, c string, lo double, hi double")
        want = spark.createDataFrame([(i, a, r) for i, k in enumerate(keys) for a, r in open_[k]], "i int, asked long, r long")
        need = {c for c, _, _ in keys}
        values = df.select(F.explode(each).alias("p")).select("p.*").filter(F.col("c").isin(sorted(need)) & F.col("v").isNotNull())
        # one row per open interval: a few per column
        share = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        bins = (values.join(F.broadcast(parts), "c").filter((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                .groupBy("i", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
        upto = F.sum("n").over(Window.partitionBy("i").orderBy("bin"))               # BINS rows at most
        hit = (bins.withColumn("upto", upto).join(F.broadcast(want), "i")
               .filter((F.col("upto") >= F.col("r")) & (F.col("upto") - F.col("n") < F.col("r"))).collect())
        nxt: dict = {}
        for h in hit:
            c = keys[h["i"]][0]
            if h["low"] == h["high"]:
                found[c, h["asked"]] = h["low"]
            elif h["r"] == h["upto"]:
                found[c, h["asked"]] = h["high"]
            elif h["r"] == h["upto"] - h["n"] + 1:
                found[c, h["asked"]] = h["low"]
            else:
                nxt.setdefault((c, h["low"], h["high"]), []).append((h["asked"], h["r"] - (h["upto"] - h["n"])))
        open_ = nxt
    return found


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def frame_summary(df: DataFrame, digits: int = 6, with_quartiles: bool = True) -> DataFrame:
    """Per-column summary (AGG7): rows, missing, and for numeric columns min,
    quartiles (exact, interpolated), max, mean and sample sd.  One aggregate
    over all columns, then the quartiles of all columns by :func:`rank_values`.
    NaN counts as missing in the quartiles.  Level counts of the other
    columns: :func:`level_summary`."""
    numeric = numeric_columns(df)
    aggs = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        x = c if f.name in numeric else F.lit(None).cast("double")
        real = F.when(~F.isnan(x.cast("double")), x.cast("double"))
        aggs += [F.count(c).alias(f"a{i}_n"), F.count_if(c.isNull()).alias(f"a{i}_na"), F.count(real).alias(f"a{i}_r"),
                 F.min(x).cast("double").alias(f"a{i}_min"), F.max(x).cast("double").alias(f"a{i}_max"),
                 F.round(F.avg(x), digits).cast("double").alias(f"a{i}_mean"),
                 F.round(F.stddev_samp(x), digits).cast("double").alias(f"a{i}_sd"),
                 F.min(real).alias(f"a{i}_lo"), F.max(real).alias(f"a{i}_hi")]
    one = df.agg(*aggs).first()                                                       # one row
    at = {f.name: i for i, f in enumerate(df.schema.fields)}
    ask = [c for c in numeric if with_quartiles and one[f"a{at[c]}_r"]]
    places = {c: {q: p * (one[f"a{at[c]}_r"] - 1) + 1 for q, p in QUARTILES.items()} for c in ask}
    got = rank_values(df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c) for c in ask]),
                      {c: sorted({k for h in places[c].values() for k in (math.floor(h), math.ceil(h))}) for c in ask},
                      {c: (one[f"a{at[c]}_lo"], one[f"a{at[c]}_hi"]) for c in ask}) if ask else {}
    rows = []
    for f in df.schema.fields:
        i, c = at[f.name], f.name
        row = [c, *[one[f"a{i}_{k}"] for k in ("n", "na", "min", "max", "mean", "sd")]]
        for q in QUARTILES:
            if c in places:
                h = places[c][q]
                lo, hi = got[c, math.floor(h)], got[c, math.ceil(h)]
                row.append(float(round(lo + (h - math.floor(h)) * (hi - lo), digits)))
            else:
                row.append(None)
        rows.append(tuple(row))
    schema = "column_name string, n long, n_missing long, min double, max double, mean double, sd double, q1 double, median double, q3 double"
    out = df.sparkSession.createDataFrame(rows, schema)
    return out if with_quartiles else out.drop(*QUARTILES)


def level_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, level, n): level counts of the named columns (AGG7) in one
    aggregate; a missing value is a NULL level."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("level")) for c in cols])
    return (df.select(F.explode(pairs).alias("p")).select("p.*")
            .groupBy("column_name", "level").agg(F.count(F.lit(1)).alias("n")))

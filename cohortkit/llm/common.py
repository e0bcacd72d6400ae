"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: rows in one Arrow batch handed to a Python task; long texts make wide rows
ARROW_ROWS = TEXT_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the Arrow batches by rows (the byte bound of the session stays)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Spark's own setting: shuffle files go when the execution that made them ends
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


ARROW_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    ``rows``: bound of the Arrow batches while it is written; the session's
    own bound holds again afterwards.

    Cuts the lineage at a table that survives lost executors, and gives the
    planner the real size of the data for its own broadcast decisions.  The
    shuffle files of the write are not needed again and go with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    held = {CLEANUP: "true", **({ARROW_BATCH: str(rows)} if rows else {})}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str,
                  name: str = "ranked") -> tuple[DataFrame, list]:
    """Position (from 0, gapless) of every row in its group, without a window.

    Rows are dealt by range over ``group + order``, so a group of any size is
    spread over many tasks; each task numbers its own sorted rows and the
    offsets of (task, group) come from one row per pair: at most the number
    of partitions plus the number of groups, which has to be bounded by a
    parameter of the caller.  Returns the frame and the group totals
    ``[(group values..., n)]``.
    """
    spark = df.sparkSession
    cols = [*group, *order]
    local = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    part = F.shiftright(F.col("_id"), 33)
    sorted_ = (df.repartitionByRange(width(spark), *cols)
               .sortWithinPartitions(*cols)
               .withColumn("_id", F.monotonically_increasing_id())
               .withColumns({"_part": part, "_local": local}).drop("_id"))
    sorted_ = materialize(sorted_, name)
    runs = (sorted_.groupBy("_part", *group)
            .agg(F.count(F.lit(1)).alias("n"), F.min("_local").alias("first")).collect())
    seen: dict[tuple, int] = {}
    rows = []
    for r in sorted(runs, key=lambda r: (r["_part"], r["first"])):
        g = tuple(r[c] for c in group)
        before = seen.get(g, 0)
        rows.append((r["_part"], *g, before - r["first"]))
        seen[g] = before + r["n"]
    schema = "_part long, " + ", ".join(f"`{c}` {dict(df.dtypes)[c]}" for c in group) + ", _shift long"
    shifts = spark.createDataFrame(rows, schema)
    on = sorted_["_part"] == shifts["_part"]
    for c in group:
        on = on & sorted_[c].eqNullSafe(shifts[c])
    # one row per (task, group): bounded by partitions + groups
    joined = sorted_.join(F.broadcast(shifts), on, "left")
    res = joined.select(*[sorted_[c] for c in df.columns], (F.col("_local") + F.col("_shift")).alias(out))
    return res, [(*g, n) for g, n in seen.items()]


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def only(df: DataFrame, **cols: Column | str) -> DataFrame:
    """Pick named inputs first, so that extra columns cannot clash later."""
    return df.select([(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in cols.items()])


def quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def wrapped(df: DataFrame, **cols: Column | str) -> DataFrame:
    """All columns in one struct ``_row`` beside the named ones, so that no name of ``df`` can clash."""
    row = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("_row")
    return df.select(row, *[(F.col(quoted(v)) if isinstance(v, str) else v).alias(k) for k, v in cols.items()])


def unwrapped(df: DataFrame, like: DataFrame, text: str | None = None) -> DataFrame:
    """The columns of ``like`` from ``_row``; with ``text``, the texts of that column replace its own
    (and ``n_chars``, where there is one, follows)."""
    out = []
    for c in like.columns:
        own = F.col("_row." + quoted(c))
        if text and c == "text":
            own = F.col(text)
        elif text and c == "n_chars":
            own = F.length(text).cast(dict(like.dtypes)[c])
        out.append(own.alias(c))
    return df.select(out)

"""Global positions in a total order, computed in parallel.

A window with an ORDER BY and no PARTITION BY runs in one task.  Instead the
frame is range-partitioned and sorted on the order, every row gets its place
(and running sums) inside its partition in one pass that keeps the sort, and
a per-partition total table -- one row per partition, so bounded by the
partition count -- gives each partition's offset.  The numbered frame is
checkpointed to the shared folder: totals and rows are then read from the
same materialised data, even after a lost executor, and nothing is shuffled
a second time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import cut_lineage

_LOCAL_BITS = (1 << 33) - 1


def _running(names: Sequence[str]):
    """Replace each named column by its running sum over the partition's rows."""
    def run(batches):
        carry = {n: 0.0 for n in names}
        for b in batches:
            cols = list(b.columns)
            for n in names:
                i = b.schema.get_field_index(n)
                v = np.nan_to_num(b.column(i).to_numpy(zero_copy_only=False)).cumsum() + carry[n]
                if len(v):
                    carry[n] = float(v[-1])
                cols[i] = pa.array(v, pa.float64())
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)
    return run


def positions(df: DataFrame, order: Sequence[str | Column], out: str = "rn",
              running: Mapping[str, Column] | None = None,
              partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position in ``order`` (make the order total, e.g.
    end it with an id) and, for each ``name -> numeric expression`` in
    ``running``, the inclusive running sum (double) of that expression in the order."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    running = dict(running or {})
    s = df.withColumns({f"__v_{k}": v.cast("double") for k, v in running.items()}) if running else df
    s = s.repartitionByRange(n, *order).sortWithinPartitions(*order)
    s = s.withColumn("__id", F.monotonically_increasing_id())
    if running:
        fields = [StructField(f.name, DoubleType()) if f.name.startswith("__v_") else f for f in s.schema.fields]
        s = s.mapInArrow(_running([f"__v_{k}" for k in running]), StructType(fields))
    s = s.withColumns({"__pid": F.shiftright("__id", 33), "__l": F.col("__id").bitwiseAND(F.lit(_LOCAL_BITS)) + 1})
    s = cut_lineage(s.drop("__id"))
    last = F.max_by(F.struct("__l", *[f"__v_{k}" for k in running]), "__l")
    tot = s.groupBy("__pid").agg(last.alias("t"))
    prev = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("__pid", F.coalesce(F.sum("t.__l").over(prev), F.lit(0)).alias("__o_rn"),
                      *[F.coalesce(F.sum(f"t.__v_{k}").over(prev), F.lit(0.0)).alias(f"__o_{k}") for k in running])
    res = s.join(F.broadcast(offs), "__pid").withColumn(out, F.col("__o_rn") + F.col("__l"))
    for k in running:
        res = res.withColumn(k, F.col(f"__o_{k}") + F.col(f"__v_{k}"))
    return res.drop(*[c for c in res.columns if c.startswith("__")])

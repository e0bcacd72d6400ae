"""Sinks (SNK1-SNK5) and id batching.  ``batch_ids`` numbers ids in one global
order with :func:`..operators.ordering.positions`, not in one task."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ordering import positions


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                compression: str | None = None) -> None:
    """One result (SNK2); ``compression`` e.g. ``gzip`` (SNK3)."""
    w = df.write.mode(mode).format(fmt)
    if compression:
        w = w.option("compression", compression)
    if fmt == "csv":
        w = w.option("header", "true")
    w.save(path)


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name.strip().lower())


def write_bundle(frames: Mapping[str, DataFrame], folder: str, fmt: str = "parquet",
                 compression: str | None = None, at_once: int = 4) -> dict[str, str]:
    """Named tables written as one deliverable (SNK1), ``at_once`` of them at a
    time, as they do not depend on each other.  Names are made safe for paths
    (``"home meds"`` -> ``home_meds``)."""
    out = {n: f"{folder.rstrip('/')}/{_safe(n)}" for n in frames}

    def one(name: str) -> None:
        write_table(frames[name], out[name], fmt, compression=compression)

    spark = next((f.sparkSession for f in frames.values()), None)
    with ThreadPoolExecutor(at_once) as pool:
        for job in [pool.submit(inheritable_thread_target(spark)(one), n) for n in frames]:
            job.result()
    return out


def read_bundle(spark, paths: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    return {n: spark.read.format(fmt).load(p) for n, p in paths.items()}


_MANIFEST = "version long, id string, name string, path string, fmt string"


def publish_bundle(frames: Mapping[str, DataFrame], folder: str, fmt: str = "parquet",
                   compression: str | None = None) -> int:
    """A deliverable that is whole or absent (SNK1).  The tables go to a folder
    of their own; the manifest, one file that names them all, is added last.
    Readers take the newest manifest's tables, so a write that fails on the
    way leaves the version before it as it is.  Returns the version."""
    spark = next(iter(frames.values())).sparkSession
    base, name = folder.rstrip("/"), uuid.uuid4().hex
    paths = write_bundle(frames, f"{base}/tables/{name}", fmt, compression)
    old = _versions(spark, base)
    version = 1 + (old.agg(F.max("version")).first()[0] or 0 if old is not None else 0)
    rows = [(version, name, n, p[len(base) + 1:], fmt) for n, p in paths.items()]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").json(f"{base}/manifest")
    return version


def _versions(spark, base: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).json(f"{base}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def read_published(spark, folder: str) -> dict[str, DataFrame]:
    """The tables of the newest version (of two written at once, the one with the larger id); {} if there is none."""
    base = folder.rstrip("/")
    every = _versions(spark, base)
    if every is None:
        return {}
    last = every.agg(F.max(F.struct("version", "id")).alias("m")).select("m.*")
    rows = every.join(F.broadcast(last), ["version", "id"]).collect()              # one row per table
    return {r["name"]: spark.read.format(r["fmt"]).load(f"{base}/{r['path']}") for r in rows}


def batch_ids(df: DataFrame, id_col: str, size: int = 40, sep: str = ";") -> DataFrame:
    """SNK4: distinct ids joined into delimited strings, in chunks of ``size``
    in id order (numeric order for numeric ids).  Each chunk holds at most
    ``size`` ids, so no group is unbounded; an unchunked list is asked for
    with a large ``size``."""
    ids = df.select(F.col(id_col).alias("id")).distinct()
    numbered = positions(ids, ["id"])
    b = numbered.withColumn("batch", F.floor((F.col("rn") - 1) / size).cast("long"))
    packed = F.array_sort(F.collect_list(F.struct("rn", F.col("id").cast(T.StringType()).alias("s"))))
    return b.groupBy("batch").agg(
        F.array_join(F.transform(packed, lambda x: x["s"]), sep).alias("ids"),
        F.count(F.lit(1)).cast("int").alias("n_ids"))

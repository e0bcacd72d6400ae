"""Spark session settings shared by the library, the tests and the bench.

Everything time-related in this library works on TIMESTAMP_NTZ values that
hold UTC, so the session zone is pinned to UTC.  The settings below are the
ones that matter at cluster scale: adaptive execution (runtime coalescing,
skew-join splitting, runtime broadcast choice), and a shuffle width the
caller sizes to the data.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "cohortkit", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster, use the cluster's session and call
    :func:`apply_conf` instead; shuffle width then follows the data size."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("COHORTKIT_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Pin the runtime SQL settings on an existing session."""
    for k, v in SESSION_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Where neither is set, a session of one process (``local[...]``, tests)
    takes a folder of its own; any other session has to be started with one.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("start the session with spark.checkpoint.dir set to a folder that the driver and "
                               "all executors share (lineage cuts and scratch tables are written there)")
        d = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never machine-local on a cluster)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable checkpoint).

    Used where a plan is re-read several times (iterative matching, row
    numbering) so that a lost executor recomputes from the checkpoint, not
    from the whole lineage.  ``localCheckpoint`` is never used.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, minimum: int = 8) -> int:
    """A starting shuffle width for ``input_bytes`` of scanned data: about one
    partition per ``target_bytes``.  AQE coalesces small partitions at run
    time, so erring high is cheap; erring low makes tasks spill."""
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))

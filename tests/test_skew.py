"""One key holds a third of all rows.  With AQE's skew thresholds lowered so
that skewed partitions are really split, the operators must return exactly
the brute-force answer."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortkit.operators.flags import attach_flags, pattern_flags
from cohortkit.operators.picks import first_by, max_at_first
from cohortkit.operators.windows import events_around

BASE = dt.datetime(2024, 1, 1)


@pytest.fixture
def skew_conf(spark):
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _rows(n=6000, seed=5):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if i % 3 == 0 else rnd.randrange(1, 200)       # key 0: a third of all rows
        t = BASE + dt.timedelta(minutes=rnd.randrange(60 * 24 * 20))
        out.append((key, i, t, rnd.choice(["view", "error", "purchase", "click"]), float(rnd.randrange(100))))
    return out


def test_hot_key_band_join(spark, skew_conf):
    rows = _rows()
    df = spark.createDataFrame(rows, "pid int, eid int, t timestamp_ntz, kind string, v double")
    anchors = df.filter(F.col("kind") == "purchase")
    facts = df.filter(F.col("kind").isin("view", "error"))
    got = sorted(r.eid for r in events_around(facts, anchors, "pid", "t", "t", 0.5, 1.0).collect())
    anc = {}
    for p, e, t, k, v in rows:
        if k == "purchase":
            anc.setdefault(p, []).append(t)
    want = sorted(e for p, e, t, k, v in rows if k in ("view", "error") and any(
        a - dt.timedelta(hours=12) <= t <= a + dt.timedelta(days=1) for a in anc.get(p, [])))
    assert got == want


def test_hot_key_picks_and_flags(spark, skew_conf):
    rows = _rows()
    df = spark.createDataFrame(rows, "pid int, eid int, t timestamp_ntz, kind string, v double")
    first = {r.pid: r.eid for r in first_by(df, "pid", ["t", "eid"]).collect()}
    want_first = {}
    for p, e, t, k, v in sorted(rows, key=lambda r: (r[2], r[1])):
        want_first.setdefault(p, e)
    assert first == want_first
    mx = {r.pid: r.v for r in max_at_first(df, "pid", "t", "v").collect()}
    tmin = {}
    for p, e, t, k, v in rows:
        tmin[p] = min(tmin.get(p, t), t)
    want_mx = {}
    for p, e, t, k, v in rows:
        if t == tmin[p]:
            want_mx[p] = max(want_mx.get(p, v), v)
    assert mx == want_mx
    base = spark.createDataFrame([(p,) for p in range(0, 205)], "pid int")
    fl = attach_flags(base, pattern_flags(df, "pid", "kind", {"err": "err", "buy": "purch"}), "pid")
    got = {r.pid: (r.err, r.buy) for r in fl.collect()}
    kinds = {}
    for p, e, t, k, v in rows:
        kinds.setdefault(p, set()).add(k)
    assert got == {p: ("error" in kinds.get(p, ()), "purchase" in kinds.get(p, ())) for p in range(205)}


def test_factor_level_of_most_rows_stays_spread(spark):
    """Level indexes and coefficients reach the rows where they are: no task gets all rows of a level."""
    from cohortkit.stats.glm import build_design, fit
    from cohortkit.stats.match import linear_predictor
    df = spark.range(0, 4000, 1, 4).select(
        F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("g"), (F.col("id") % 7).cast("double").alias("q"),
        (F.col("id") * 37 % 11 < 5).alias("y"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        design = build_design(df, "y", ["g", "q"])
        scored = linear_predictor(fit(design), df)
        for rows in (design.frame, scored):
            sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
            assert sorted(sizes) == [1000] * 4
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

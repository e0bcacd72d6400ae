import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from cohortkit.functions.text import flag_text
from cohortkit.functions.timeops import age_years, local_day, local_to_utc, utc_to_local
from cohortkit.operators.windows import events_around, events_before

A = dt.datetime(2024, 1, 10, 12, 0)


def test_window_edges_and_two_anchors(spark):
    anchors = spark.createDataFrame([(1, A), (1, A + dt.timedelta(hours=6))], "pid int, at timestamp_ntz")
    facts = spark.createDataFrame([
        (1, 10, A - dt.timedelta(hours=12)),                  # exactly -12 h: kept
        (1, 11, A + dt.timedelta(hours=24)),                  # exactly +24 h: kept
        (1, 12, A + dt.timedelta(hours=2)),                   # inside both windows: once
        (1, 13, A - dt.timedelta(hours=12, microseconds=1)),  # just outside
        (1, 14, A + dt.timedelta(hours=30, microseconds=1)),  # outside both
        (2, 15, A),                                           # other person
    ], "pid int, eid int, t timestamp_ntz")
    got = sorted(r.eid for r in events_around(facts, anchors, "pid", "t", "at", 0.5, 1.0).collect())
    assert got == [10, 11, 12]


def test_bucketed_equals_plain(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    anchors = [(rnd.randrange(5), base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 10))) for _ in range(60)]
    facts = [(rnd.randrange(5), i, base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 10))) for i in range(600)]
    a = spark.createDataFrame(anchors, "pid int, at timestamp_ntz")
    f = spark.createDataFrame(facts, "pid int, eid int, t timestamp_ntz")
    got = sorted(r.eid for r in events_around(f, a, "pid", "t", "at", 0.5, 1.0).collect())
    want = sorted({e for p, e, t in facts for q, at in anchors
                   if p == q and at - dt.timedelta(hours=12) <= t <= at + dt.timedelta(days=1)})
    assert got == want
    wider = sorted(r.eid for r in events_around(f, a, "pid", "t", "at", 1.0, 2.0).collect())
    assert set(got) <= set(wider)            # widening a window never loses rows


def test_open_stay_and_bound_tie(spark):
    d = dt.datetime(2020, 5, 1)
    enc = spark.createDataFrame([(1, d), (2, None)], "eid int, disch timestamp_ntz")
    ev = spark.createDataFrame([(1, d), (1, d - dt.timedelta(days=1)), (2, d)], "eid int, t timestamp_ntz")
    le = events_before(ev, enc, "eid", "t", "disch", strict=False).collect()
    lt = events_before(ev, enc, "eid", "t", "disch", strict=True).collect()
    assert sorted(r.t for r in le) == [d - dt.timedelta(days=1), d]   # measures keep the tie
    assert [r.t for r in lt] == [d - dt.timedelta(days=1)]            # drugs drop it
    assert all(r.eid == 1 for r in le + lt)                           # NULL discharge keeps nothing


def test_zone_days_and_dst(spark):
    tz = "America/Chicago"
    df = spark.createDataFrame([(dt.datetime(2019, 7, 4, 4, 59),), (dt.datetime(2019, 7, 4, 5, 1),)],
                               "t timestamp_ntz")
    days = [r.d for r in df.select(local_day("t", tz).alias("d")).collect()]
    assert days == [dt.date(2019, 7, 3), dt.date(2019, 7, 4)]
    row = spark.range(1).select(
        local_to_utc(dt.datetime(2016, 3, 13, 2, 30), tz).alias("gap"),
        local_to_utc(dt.datetime(2016, 11, 6, 1, 30), tz).alias("overlap"),
        utc_to_local(F.lit(dt.datetime(2016, 1, 1, 6, 0)).cast("timestamp_ntz"), tz).alias("back")).first()
    assert row.gap == dt.datetime(2016, 3, 13, 8, 30)
    assert row.overlap == dt.datetime(2016, 11, 6, 6, 30)
    assert row.back == dt.datetime(2016, 1, 1, 0, 0)


def test_age_truncates_toward_zero(spark):
    df = spark.createDataFrame([
        (dt.datetime(2000, 6, 14, 0), dt.datetime(1950, 6, 16)),    # before 50 * 365.25 days
        (dt.datetime(2000, 6, 17, 12), dt.datetime(1950, 6, 16)),   # after it
        (dt.datetime(2000, 1, 1, 12), dt.datetime(2000, 6, 1)),     # birth after admission
    ], "adm timestamp_ntz, birth timestamp_ntz")
    got = [r.a for r in df.select(age_years("adm", "birth").alias("a")).collect()]
    assert got == [49, 50, 0]


def test_flag_text_null_is_false(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "f int")
    assert [r.x for r in df.select(flag_text("f").alias("x")).collect()] == ["TRUE", "FALSE", "FALSE"]


def test_composite_key_bound(spark):
    d = dt.datetime(2020, 5, 1)
    enc = spark.createDataFrame([(1, 10, d), (1, 11, d)], "eid int, pid int, disch timestamp_ntz")
    ev = spark.createDataFrame([(1, 10, d), (1, 99, d), (1, 11, d + dt.timedelta(days=1))],
                               "eid int, pid int, t timestamp_ntz")
    got = events_before(ev, enc, ["eid", "pid"], "t", "disch", strict=False).collect()
    assert [(r.eid, r.pid) for r in got] == [(1, 10)]     # person must match too; bound holds


def test_prompt_window_defaults_and_bad_text(spark):
    import datetime as dt

    from cohortkit.functions.timeops import DEFAULT_BEGIN, DEFAULT_END, prompt_window
    one = spark.range(1)
    lo, hi = prompt_window("", None, "MM/dd/yyyy")
    assert tuple(one.select(lo, hi).first()) == (DEFAULT_BEGIN, DEFAULT_END)
    lo, hi = prompt_window("02/03/1997", " ", "MM/dd/yyyy")
    assert tuple(one.select(lo, hi).first()) == (dt.datetime(1997, 2, 3), DEFAULT_END)
    bad, _ = prompt_window("1997-02-03", None, "MM/dd/yyyy")
    with pytest.raises(Exception, match="does not fit the mask"):
        one.select(bad).collect()

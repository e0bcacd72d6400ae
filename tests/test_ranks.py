"""Quartiles of many columns by histogram refinement."""
import random

import numpy as np
from pyspark.sql import functions as F

from cohortkit.operators import frames
from cohortkit.operators.frames import frame_summary, rank_values


def test_ranks_of_many_columns(spark, monkeypatch):
    rnd = random.Random(7)
    n = 900
    cols = {"a": [rnd.random() for _ in range(n)], "b": [float(rnd.randrange(3)) for _ in range(n)],
            "c": [rnd.choice([-1e308, 1e308, 5.0, 5.000000001, 1e-300]) for _ in range(n)],
            "d": [rnd.gauss(0, 1) * 10 ** rnd.randrange(-9, 9) if rnd.random() < 0.8 else None for _ in range(n)],
            "e": [7.0] * n, "f": [None] * n}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    for bins in (2, 5, 1 << 12):
        monkeypatch.setattr(frames, "BINS", bins)
        ask = ["a", "b", "c", "d", "e"]
        own = {c: sorted(v for v in cols[c] if v is not None) for c in ask}
        ranks = {c: [1, 2, len(v) // 3, len(v) // 2, len(v) - 1, len(v)] for c, v in own.items()}
        got = rank_values(df, ranks, {c: (v[0], v[-1]) for c, v in own.items()})
        assert got == {(c, r): own[c][r - 1] for c in ask for r in ranks[c]}
    t = {r["column_name"]: r for r in frame_summary(df).collect()}
    for c in ("a", "b", "d", "e"):
        v = [x for x in cols[c] if x is not None]
        assert [t[c]["q1"], t[c]["median"], t[c]["q3"]] == [round(float(x), 6) for x in np.quantile(v, [0.25, 0.5, 0.75])]
        assert t[c]["n"] == len(v) and t[c]["n_missing"] == n - len(v)
    assert t["f"]["median"] is None and t["f"]["n_missing"] == n


def test_summary_of_odd_frames(spark):
    df = spark.createDataFrame([(1, "x", float("nan")), (2, None, 1.0), (4, "y", 3.0)], "`a.b` int, s string, v double")
    t = {r["column_name"]: r for r in frame_summary(df).collect()}
    assert t["a.b"]["median"] == 2.0 and t["a.b"]["q1"] == 1.5 and t["s"]["n"] == 2 and t["s"]["q1"] is None
    assert t["v"]["median"] == 2.0
    none = {r["column_name"]: r for r in frame_summary(df.filter(F.lit(False))).collect()}
    assert none["a.b"]["n"] == 0 and none["a.b"]["median"] is None
    assert frame_summary(df, with_quartiles=False).columns == ["column_name", "n", "n_missing", "min", "max", "mean", "sd"]

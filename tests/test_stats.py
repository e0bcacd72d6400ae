import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortkit.stats.glm import Model, Z975, build_design, fit, fit_many, or_table, profile_limits, solve_models
import cohortkit.stats.match as M
from cohortkit.stats.match import linear_predictor, match_pairs, matched_rows, nearest_controls
from cohortkit.stats.step import backward_aic


def _frame(spark, n=4000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        x = rnd.random() < 0.4
        g = rnd.choice(["a", "b", "c"])
        q = float(rnd.randrange(10))
        eta = -0.5 + 0.8 * x + {"a": 0.0, "b": 0.4, "c": -0.7}[g] + 0.05 * q
        y = rnd.random() < 1 / (1 + math.exp(-eta))
        rows.append((i, y, x, g, q, (x and rnd.random() < 0.5) or None if i % 50 == 0 else x))
    return spark.createDataFrame(rows, "id long, y boolean, x boolean, g string, q double, x_miss boolean")


def test_saturated_closed_form(spark):
    df = _frame(spark)
    lf = fit(build_design(df, "y", ["x"]))
    c = {(r.y, r.x): r["count"] for r in df.groupBy("y", "x").count().collect()}
    a, b, cc, d = c[(True, True)], c[(False, True)], c[(True, False)], c[(False, False)]
    assert lf.labels == ["(Intercept)", "xTRUE"]
    assert abs(lf.coef[0] - math.log(cc / d)) < 1e-8
    assert abs(lf.coef[1] - math.log(a * d / (b * cc))) < 1e-8
    assert abs(lf.se[1] - math.sqrt(1 / a + 1 / b + 1 / cc + 1 / d)) < 1e-8
    # p-value of a Wald z test
    assert abs(lf.p[1] - math.erfc(abs(lf.z[1]) / math.sqrt(2))) < 1e-10
    t = {r.term: r for r in or_table(lf, spark, conf="wald", digits=None).collect()}
    assert abs(t["xTRUE"].estimate - a * d / (b * cc)) < 1e-6


def test_compressed_equals_rows_and_aic(spark):
    df = _frame(spark)
    # a numeric term keeps the rows as they are; factors and logicals are folded to patterns
    full = fit(build_design(df.withColumn("z", F.lit(0.0)), "y", ["x", "g", "z"]))
    comp = fit(build_design(df, "y", ["x", "g"]))
    assert full.aliased == ["z"] and full.design.frame.count() == 4000 and comp.design.frame.count() == 6
    for u, v in zip(full.coef[:4], comp.coef):
        assert abs(u - v) < 1e-9
    for u, v in zip(full.se[:4], comp.se):
        assert abs(u - v) < 1e-9
    assert abs(full.deviance - comp.deviance) < 1e-7 and abs(full.null_deviance - comp.null_deviance) < 1e-9
    assert abs(comp.aic - (comp.deviance + 2 * len(comp.coef))) < 1e-9 and abs(full.aic - comp.aic) < 1e-7
    assert comp.labels == ["(Intercept)", "xTRUE", "gb", "gc"] and comp.converged


def test_separated_data_are_flagged(spark):
    df = spark.createDataFrame([(i, i >= 50, i >= 50) for i in range(100)], "id long, y boolean, x boolean")
    lf = fit(build_design(df, "y", ["x"]))
    assert not lf.converged
    t = {r.term: r for r in or_table(lf, spark).collect()}
    assert t["xTRUE"].conf_low is None and t["xTRUE"].conf_high is None and not t["xTRUE"].converged


def test_factor_of_many_levels(spark):
    """More levels than any cap: ordered by Spark and fitted; a saturated factor has the log odds of its levels."""
    rows = [(f"L{i:04d}", (i * j) % 7 < 3) for i in range(1, 301) for j in range(1, 15)]
    df = spark.createDataFrame(rows, "g string, y boolean")
    from cohortkit.operators.recode import level_table
    assert level_table(df, "g", by="freq", first="L0100").orderBy("position").first()["level"] == "L0100"
    d = build_design(df, "y", ["g"])
    s = solve_models(d, [Model([0, *range(1, 300)])])[0]
    rate = {r.g: r.p for r in df.groupBy("g").agg(F.avg(F.col("y").cast("int")).alias("p")).collect()}
    for label, b in zip(d.labels, s.beta[1:]):
        p = rate[label[1:]]
        if 0 < p < 1 and 0 < rate["L0001"] < 1:
            assert abs(b - (math.log(p / (1 - p)) - math.log(rate["L0001"] / (1 - rate["L0001"])))) < 1e-6
    many = spark.range(3000).select(F.format_string("K%05d", "id").alias("g"))
    assert level_table(many, "g", by="alpha").agg(F.max("position")).first()[0] == 3000


def test_score_equations(spark):
    df = _frame(spark)
    lf = fit(build_design(df, "y", ["x", "g", "q"]))
    p = 1 / (1 + F.exp(-F.col("__eta")))
    r = F.col("y").cast("double") - p
    s = linear_predictor(lf, df).agg(F.sum(r), F.sum(r * F.col("x").cast("double")), F.sum(r * F.col("q")),
               F.sum(r * (F.col("g") == "b").cast("double"))).first()
    assert all(abs(v) < 1e-6 for v in s)


def test_collinear_term_reported(spark):
    df = _frame(spark).withColumn("x2", F.col("x"))
    lf = fit(build_design(df, "y", ["x", "x2"]))
    assert lf.aliased == ["x2TRUE"]
    assert lf.coef[lf.labels.index("x2TRUE")] is None


def _constrained(lf, j, value):
    rest = [c for c in lf.columns if c != lf.columns[j]]
    return solve_models(lf.design, [Model(rest, {lf.columns[j]: value})])[0].deviance


def test_profile_limits_deviance_rise(spark):
    df = _frame(spark, n=1500)
    # a one-term model profiles its intercept with one feature left, and its term with none but the intercept
    for lf in (fit(build_design(df, "y", ["x", "q"])), fit(build_design(df, "y", ["x"]))):
        for j, (lo, hi) in enumerate(profile_limits(lf)):
            assert lo < lf.coef[j] < hi
            for b in (lo, hi):
                assert abs(_constrained(lf, j, b) - lf.deviance - Z975 ** 2) < 1e-5


def test_stepwise_invariants_and_fixed_rows(spark):
    df = _frame(spark, n=2000)
    d = build_design(df, "y", ["x", "g", "q", "x_miss"])
    n = d.n_rows
    lf = backward_aic(d)
    assert lf.design.n_rows == n                 # same rows at every step
    smaller = fit_many(d, [[k for k in lf.terms if k != t] for t in lf.terms])
    assert lf.terms and all(s.aic >= lf.aic - 1e-9 for s in smaller)     # no single removal lowers AIC


def _serial_greedy(cases, controls, ratio):
    order = sorted(cases, key=lambda c: (-c[1], c[0]))
    free = dict(controls)
    pairs = []
    for r in range(1, ratio + 1):
        for cid, s in order:
            if not free:
                break
            best = min(free.items(), key=lambda kv: (abs(kv[1] - s), kv[0]))
            pairs.append((cid, best[0], r))
            del free[best[0]]
    return sorted(pairs)


@pytest.mark.parametrize("seed,n_case,n_ctl", [(1, 6, 20), (2, 8, 11), (3, 10, 12), (4, 5, 40)])
def test_matching_equals_serial_greedy(spark, seed, n_case, n_ctl):
    rnd = random.Random(seed)
    ids = list(range(n_case + n_ctl))
    rnd.shuffle(ids)
    # tied scores on purpose: few distinct values
    rows = [(ids[i], float(rnd.randrange(12)), i < n_case) for i in range(n_case + n_ctl)]
    df = spark.createDataFrame(rows, "id long, score double, t boolean")
    got = sorted((r.case_id, r.control_id, r.round) for r in match_pairs(df, "t", "score", "id", ratio=2).collect())
    want = _serial_greedy([(i, s) for i, s, t in rows if t], [(i, s) for i, s, t in rows if not t], 2)
    assert got == want
    assert len({c for _, c, _ in got}) == len(got)          # no control reused
    m = matched_rows(df, match_pairs(df, "t", "score", "id", ratio=2), "t", "score", "id").collect()
    ctl_w = [r.weights for r in m if not r.t]
    assert abs(sum(ctl_w) - len(ctl_w)) < 1e-5


def test_nearest_controls_equal_brute_force(spark):
    rnd = random.Random(11)
    rows = [(i, float(rnd.randrange(30)), rnd.random() < 0.3) for i in range(120)]
    cases = spark.createDataFrame([(i, s) for i, s, t in rows if t], "id long, score double")
    ctl = [(i, s) for i, s, t in rows if not t]
    controls = spark.createDataFrame(ctl, "id long, score double")
    got = sorted((r.case_id, r.control_id, r.cand_rank) for r in nearest_controls(cases, controls, 3).collect())
    want = []
    for i, s, t in rows:
        if t:
            best = sorted(ctl, key=lambda c: (abs(c[1] - s), c[0]))[:3]
            want += [(i, c[0], k + 1) for k, c in enumerate(best)]
    assert got == sorted(want)


def test_matching_independent_of_partitioning(spark):
    rnd = random.Random(21)
    rows = [(i, float(rnd.randrange(15)), rnd.random() < 0.35) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, score double, t boolean")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(tuple(r) for r in match_pairs(df, "t", "score", "id", ratio=2).select(
                "case_id", "control_id", "round").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def _by_blocks(cases, controls, size):
    """The matcher's passes without Spark: same blocks, same states, same task function."""
    rows = sorted([(-s, 0, i, s) for i, s in cases] + [(-s, 1, i, s) for i, s in controls])
    rank, numbered = 0, []
    for n, (_, k, i, s) in enumerate(rows):
        rank += k
        numbered.append((n // size, k, n + 1, i, s, rank))
    blocks = []
    for b in range(numbered[-1][0] + 1 if rows else 0):
        c = [r for r in numbered if r[0] == b and r[1]]
        blocks.append(M._Block(sum(r[0] == b and not r[1] for r in numbered), c[0][5] if c else 0, c[-1][5] if c else 0,
                               max((r[4] for r in c), default=None), min((r[4] for r in c), default=None)))
    M._mark_shared(blocks)
    n_ctl = max((b.last for b in blocks), default=0)
    by_rank = {r[5]: r for r in numbered if r[1]}
    left, pairs, passes, fed = {}, {}, 0, 0
    while True:
        states, todo = M._states(blocks)
        if not todo:
            return sorted(x for o in pairs.values() for x in o), passes, fed
        out = {}
        for i in todo:
            (start, top, _), b = states[i], blocks[i]
            feed = [(i, M.BELOW, d, by_rank[d][3], by_rank[d][4], d <= b.last)
                    for d in range(start, min(n_ctl, max(b.last, start - 1) + b.n_cases) + 1)]
            feed += [(i, M.CASE, r[2], r[3], r[4], False) for r in numbered if r[0] == i and not r[1]]
            at = 0
            for j, v, first, n in top:
                feed += [(i, M.ABOVE, at + k, *left[(j, v, first + k)], False) for k in range(n)]
                at += n
            fed += len(feed)
            if feed:
                out[i] = M._run_block(pd.DataFrame(feed, columns=[c.split()[0] for c in M._IN.split(", ")]))
        for i in todo:
            o = out.get(i)
            M._note(blocks[i], states[i], passes, None if o is None else o[o.kind == M.SUMMARY].iloc[0].to_dict())
            pairs[i] = [] if o is None else [(int(r.case_id), int(r.control_id)) for r in o[o.kind == M.MATCH].itertuples()]
            if o is not None:
                left.update({(i, passes, int(r.ord)): (r.control_id, r.score) for r in o[o.kind == M.LEFT].itertuples()})
        passes += 1


def test_blocks_equal_serial_greedy():
    """Random cases and controls with many ties, blocks of 1 to 9 rows."""
    rnd = random.Random(5)
    for _ in range(250):
        n, values, share = rnd.randint(1, 40), rnd.choice([3, 8, 30, 1000]), rnd.choice([0.2, 0.5, 0.8])
        rows = [(i, float(rnd.randrange(values)), rnd.random() < share) for i in range(n)]
        rnd.shuffle(rows)
        cases, controls = [(i, s) for i, s, t in rows if t], [(i, s) for i, s, t in rows if not t]
        got = _by_blocks(cases, controls, rnd.randint(1, 9))[0]
        assert got == [(c, k) for c, k, _ in _serial_greedy(cases, controls, 1)]


def test_rows_and_passes_stay_bounded_on_ties_and_separated_scores():
    """2,400 tied cases: what the blocks are fed grows with the rows, not with their square."""
    rnd = random.Random(6)
    fed = []
    for n in (600, 2400):
        pairs, passes, rows = _by_blocks([(i, 0.5) for i in range(n)], [(n + i, 0.5) for i in range(2 * n)], n // 8)
        assert len(pairs) == n and passes <= 25
        fed.append(rows / passes)
    assert fed[1] <= 4.5 * fed[0]
    above = _by_blocks([(i, 1 + rnd.random()) for i in range(600)], [(600 + i, rnd.random()) for i in range(1200)], 50)
    assert above[1] <= 4 and len(above[0]) == 600


def test_passes_on_one_tied_score_and_on_a_third_tied():
    """36 blocks: the chain of guesses settles in a few passes, with the pairs of the serial walk."""
    rnd = random.Random(1)
    n = 720
    tied = [(i, 0.5) for i in range(3 * n)]
    third = [(i, 0.5 if rnd.random() < 1 / 3 else rnd.random()) for i in range(3 * n)]
    for rows in (tied, third):
        cases, controls = rows[:n], rows[n:]
        pairs, passes, _ = _by_blocks(cases, controls, n // 12)
        assert passes <= 7
        assert pairs == [(c, k) for c, k, _ in _serial_greedy(cases, controls, 1)]


@pytest.mark.parametrize("seed,rows_n,block_rows", [(31, 45, 4), (32, 45, 7), (41, 20, 3)])
def test_matching_small_blocks_equal_serial_greedy(spark, seed, rows_n, block_rows):
    rnd = random.Random(seed)
    rows = [(i, float(rnd.randrange(10)), i < 14 if seed == 41 else rnd.random() < 0.3) for i in range(rows_n)]
    df = spark.createDataFrame(rows, "id long, score double, t boolean")
    got = sorted((r.case_id, r.control_id, r.round) for r in
                 match_pairs(df, "t", "score", "id", ratio=2, block_rows=block_rows).collect())
    want = _serial_greedy([(i, s) for i, s, t in rows if t], [(i, s) for i, s, t in rows if not t], 2)
    assert got == want

"""Models with a factor of many levels, merged windows, pushed prefix classes."""
import datetime as dt
import math
import random
import re

from pyspark.sql import functions as F

from cohortkit.operators.predicates import literal_prefixes, matches
from cohortkit.operators.windows import events_around
from cohortkit.stats.absorb import fit_absorbed
from cohortkit.stats.glm import build_design, fit
from cohortkit.stats.match import propensity


def _rows(n_levels, per, seed=4):
    rnd = random.Random(seed)
    rows = []
    for lv in range(n_levels):
        a = rnd.uniform(-1, 1)
        for j in range(per):
            x, g, q = rnd.random() < 0.4, rnd.choice("abc"), float(rnd.randrange(8))
            y = rnd.random() < 1 / (1 + math.exp(-(a + 0.7 * x + {"a": 0, "b": 0.4, "c": -0.5}[g] + 0.05 * q)))
            rows.append((f"L{lv:04d}", bool(j % 2) if j < 2 else y, x, g, q))
    return rows


SCHEMA = "lv string, y boolean, x boolean, g string, q double"


def test_absorbed_equals_dense(spark):
    df = spark.createDataFrame(_rows(60, 25), SCHEMA)
    for terms in (["x", "g", "q"], ["x"], []):
        one, two = fit_absorbed(df, "y", "lv", terms), fit(build_design(df, "y", ["lv", *terms]))
        assert one.converged and abs(one.deviance - two.deviance) < 1e-6 and abs(one.aic - two.aic) < 1e-6
        want = {lb: (b, se) for lb, b, se in zip(two.labels, two.coef, two.se)}
        for lb, b, se in zip(one.labels, one.coef, one.se):
            assert abs(b - want[lb][0]) < 1e-6 and abs(se - want[lb][1]) < 1e-6
        rows = one.levels.collect()
        assert len(rows) == 60 and one.baseline == "L0000"
        for r in rows:
            if r.level == "L0000":
                assert r.estimate is None and abs(r.effect - want["(Intercept)"][0]) < 1e-6
            else:
                b, se = want[f"lv{r.level}"]
                assert abs(r.estimate - b) < 1e-6 and abs(r.std_error - se) < 1e-6


def test_separated_levels_do_not_touch_the_terms(spark):
    rows = _rows(20, 30)
    more = [("all", True, i % 2 == 0, "a", 1.0) for i in range(9)] + [("none", False, i % 3 == 0, "b", 2.0) for i in range(9)]
    odd = [(None, True, True, "a", 1.0), ("L0001", None, True, "a", 1.0), ("L0001", True, None, "a", 1.0)]
    df, both = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows + more + odd, SCHEMA)
    one, two = fit_absorbed(df, "y", "lv", ["x"]), fit_absorbed(both, "y", "lv", ["x"])
    assert abs(one.coef[0] - two.coef[0]) < 1e-9 and abs(one.deviance - two.deviance) < 1e-9 and not two.converged
    sep = {r.level: (r.separated, r.estimate) for r in two.levels.collect() if r.separated}
    assert sep == {"all": (True, None), "none": (True, None)}
    p = {(r.lv, r.x): r.p for r in two.predict(both, "p").collect()}
    assert p[("all", True)] == 1.0 and p[("none", True)] == 0.0 and p[(None, True)] is None and p[("L0001", None)] is None
    empty = fit_absorbed(df.filter("lv = 'none'"), "y", "lv", [])
    assert empty.levels.count() == 0 and empty.baseline is None


def test_levels_without_number(spark):
    """100,000 levels: no column per level anywhere; the score equations hold."""
    df = spark.range(400_000).select(
        F.concat(F.lit("L"), (F.col("id") % 100_000).cast("string")).alias("lv"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) < 30 + 20 * (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 4).cast("int")).alias("y"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)) < 4).alias("x"))
    lf = fit_absorbed(df, "y", "lv", ["x"])
    assert lf.levels.count() == 100_000
    r = F.col("y").cast("double") - F.col("p")
    s = lf.predict(df, "p").agg(F.sum(r), F.sum(r * F.col("x").cast("double"))).first()
    assert abs(s[0]) < 1e-3 and abs(s[1]) < 1e-3
    assert df.count() == propensity(df, "y", ["x"], absorb="lv").filter("score between 0 and 1").count()


def test_windows_of_many_anchors(spark):
    rnd = random.Random(2)
    t0 = dt.datetime(2020, 1, 1)
    anchors = [(1, t0 + dt.timedelta(seconds=rnd.randrange(4 * 86400))) for _ in range(10_000)]
    anchors += [(2, t0 + dt.timedelta(hours=6 * i)) for i in range(0, 60, 7)] + [(3, None), (None, t0)]
    facts = [(i, rnd.choice([1, 2, 2, 2, 3, None]), t0 + dt.timedelta(seconds=rnd.randrange(-86400, 20 * 86400))) for i in range(1500)]
    f = spark.createDataFrame(facts, "id long, k int, t timestamp_ntz")
    a = spark.createDataFrame(anchors, "k int, at timestamp_ntz")
    for lo, hi in ((0.25, 0.5), (0.0, 0.0), (0.01, 0.0), (1.0, 10.0)):
        got = {r["id"] for r in events_around(f, a, "k", "t", "at", lo, hi).collect()}
        by = {}
        for k, s in anchors:
            if k is not None and s is not None:
                by.setdefault(k, set()).add(s)
        want = {i for i, k, t in facts if any(s - dt.timedelta(days=lo) <= t <= s + dt.timedelta(days=hi) for s in by.get(k, ()))}
        assert got == want


def test_prefix_classes(spark, tmp_out):
    assert literal_prefixes("^027[0-3]") == ["0270", "0271", "0272", "0273"]
    assert literal_prefixes("^a[bc]d[ef]$") == ["abde", "abdf", "acde", "acdf"]
    assert literal_prefixes("^a[bc]*d") == ["a"] and literal_prefixes("^ab+c") == ["ab"] and literal_prefixes("^ab?c") == ["a"]
    assert literal_prefixes("^[^a]b") == [] and literal_prefixes("a[bc]") == [] and literal_prefixes("^(a|b)") == []
    assert literal_prefixes(r"^a\.[1-2]x") == ["a.1x", "a.2x"] and literal_prefixes("^[a-z][a-z]") == [chr(c) for c in range(97, 123)]
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abc0123.") for _ in range(rnd.randrange(6))) for _ in range(400)] + [None]
    spark.createDataFrame([(t,) for t in texts], "c string").write.parquet(tmp_out)
    df = spark.read.parquet(tmp_out)
    for p in ("^a[bc]", "^0[0-2]1?", "^[ab]+c", r"^a\.", "^[a-c][0-3][ab]", "^a[-b]", "^[]a]"):
        try:
            rx = re.compile(p)
        except re.error:
            continue
        assert df.filter(matches("c", p)).count() == sum(t is not None and bool(rx.search(t)) for t in texts), p
    plan = df.filter(matches("c", "^0[1-2]"))._jdf.queryExecution().toString()
    assert "StringStartsWith(c,01),StringStartsWith(c,02)" in plan.replace("Or(", "").replace(" ", "") or "StringStartsWith(c,01)" in plan

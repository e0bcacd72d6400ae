"""Analysis layer (PL19, PL21-PL24): recoding, levels, models, matching."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fill, first_true, is_one, present, safe_number, strip_prefix, title_case, to_missing
from ..operators.frames import frame_summary, level_summary, map_columns, map_type, stack_by_name
from ..operators.recode import dummies, level_table, levels
from ..session import scratch_path
from ..sources.sinks import write_table
from ..sources.tables import load, read_positional
from ..stats.absorb import fit_absorbed
from ..stats.glm import build_design, fit, or_table
from ..stats.match import match_pairs, matched_rows, propensity
from ..stats.step import backward_aic
from .newton_sql import absorbed_sql, backward_sql, newton_ctes, profile_ctes
from .registry import register

Z = "1.959963984540054"   # qnorm(0.975), used by the Wald-limit oracles


def _p_sql(z: str) -> str:
    """Two-sided normal tail of ``z``: Simpson's rule over [|z|, |z| + 12] in 2,000 steps."""
    f = f"exp(-pow(abs({z}) + k * 0.006, 2) / 2)"
    return (f"round(2 * 0.006 / 3 / sqrt(2 * pi()) * list_sum(list_transform(range(0, 2001), lambda k: "
            f"{f} * (CASE WHEN k = 0 OR k = 2000 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END))), 6)")


TABLE_SQL = f"""
SELECT term, round(exp(b), 6) AS estimate, round(se, 6) AS std_error, round(b / se, 6) AS statistic,
       {_p_sql("(b / se)")} AS p_value,
       round(exp(b - {Z} * se), 6) AS conf_low, round(exp(b + {Z} * se), 6) AS conf_high, true AS converged FROM e"""


def _t(spark, sf_dir, name):
    return load(spark, sf_dir, name)


# --- recoding (PL21) ----------------------------------------------------------

@register("map_columns", """
SELECT p_partkey,
       array_to_string(list_transform(string_split(p_name, ' '),
                       lambda x: upper(x[1]) || lower(x[2:])), ' ') AS p_name,
       lower(p_brand) AS p_brand, upper(lower(p_type)) AS p_type, p_size = 1 AS p_size
FROM part""")
def map_columns_q(spark, sf_dir):
    """PRJ5 + SC12 + SC15: one function applied to a list of named columns."""
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    p = map_columns(p, ["p_name"], title_case)
    p = map_columns(p, ["p_brand", "p_type"], F.lower)
    p = map_columns(p, ["p_type"], F.upper)
    return map_columns(p, ["p_size"], is_one)


@register("strip_prefix", """
SELECT c_custkey, regexp_replace(c_name, '^Customer#0*', '') AS fin FROM customer""")
def strip_prefix_q(spark, sf_dir):
    """SC13: leading pattern removed from an id text."""
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", strip_prefix("c_name", "^Customer#0*").alias("fin"))


@register("safe_number", """
SELECT event_id, TRY_CAST(CASE WHEN event_type IN ('view', 'click') THEN CAST(value AS VARCHAR)
                               ELSE event_type END AS DOUBLE) AS result_num
FROM events""")
def safe_number_q(spark, sf_dir):
    """SC14: a text result column mixing numbers and words -> number or NULL."""
    e = _t(spark, sf_dir, "events")
    text = F.when(F.col("event_type").isin("view", "click"), F.col("value").cast("string")).otherwise(F.col("event_type"))
    return e.select("event_id", safe_number(text).alias("result_num"))


RACE_FLAGS = [("f_debt", "debt"), ("f_building", "building"), ("f_low_nation", "low_nation")]


def _flag_frame(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey",
                    (F.col("c_acctbal") < 0).alias("f_debt"),
                    F.nullif(F.col("c_mktsegment") == "BUILDING", F.lit(False)).alias("f_building"),
                    (F.col("c_nationkey") < 10).alias("f_low_nation"))


@register("collapse_flags", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt'
                       WHEN nullif(c_mktsegment = 'BUILDING', false) THEN 'building'
                       WHEN c_nationkey < 10 THEN 'low_nation' END AS label
FROM customer""")
def collapse_flags(spark, sf_dir):
    """SC8: first TRUE flag gives the label; NULL flags do not match; no
    match gives NULL."""
    f = _flag_frame(spark, sf_dir)
    return f.select("c_custkey", first_true(RACE_FLAGS).alias("label"))


def _device_frame(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    dev = to_missing(F.substring(F.col("p_size").cast("string"), -1, 1), "0")
    return p.select("p_partkey", "p_size", dev.alias("device"))


@register("recode_missing", """
SELECT p_partkey, upper(coalesce(nullif(right(CAST(p_size AS VARCHAR), 1), '0'), 'none')) AS mcs_device,
       nullif(right(CAST(p_size AS VARCHAR), 1), '0') IS NOT NULL AS mcs
FROM part""")
def recode_missing(spark, sf_dir):
    """SC9-SC11: '0' -> missing, presence flag, missing -> 'none', upper case."""
    d = _device_frame(spark, sf_dir)
    return d.select("p_partkey", F.upper(fill("device", "none")).alias("mcs_device"), present("device").alias("mcs"))


@register("complete_rows", """
SELECT p_partkey, nullif(right(CAST(p_size AS VARCHAR), 1), '0') AS device FROM part
WHERE nullif(right(CAST(p_size AS VARCHAR), 1), '0') IS NOT NULL AND NOT (p_size > 40)""")
def complete_rows(spark, sf_dir):
    """FLT10 + FLT11: rows with the recoded value present and a logical FALSE."""
    d = _device_frame(spark, sf_dir).withColumn("big", F.col("p_size") > 40)
    return d.filter(F.col("device").isNotNull()).filter(~F.col("big")).select("p_partkey", "device")


@register("level_order", """
WITH c AS (SELECT n.n_name AS level, count(*) AS n FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
           GROUP BY 1)
SELECT level, n,
       CAST(row_number() OVER (ORDER BY CASE WHEN level = 'GERMANY' THEN 0 ELSE 1 END, n DESC, level) AS INTEGER)
         AS position,
       CAST(row_number() OVER (ORDER BY level) AS INTEGER) AS alpha_position
FROM c""")
def level_order(spark, sf_dir):
    """AGG6 + CAT1-CAT3: levels by frequency (ties by name) with one level
    moved first, next to the default alphabetical position."""
    c = _t(spark, sf_dir, "customer").join(
        _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    freq = level_table(c, "n_name", by="freq", first="GERMANY")
    alpha = level_table(c, "n_name", by="alpha").select("level", F.col("position").alias("alpha_position"))
    return freq.join(alpha, "level").select("level", "n", "position", "alpha_position")


SEGMENTS_OTHER = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("dummy_columns", """
SELECT c_custkey, """ + ", ".join(
    f"CAST(CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS INTEGER) AS c_mktsegment_{s}" for s in SEGMENTS_OTHER)
    + " FROM customer")
def dummy_columns(spark, sf_dir):
    """CAT4: treatment dummies, first level (forced: AUTOMOBILE) is the
    baseline and gets no column.  The levels are those of the table (CAT2)."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    out = dummies(c, "c_mktsegment", levels(c, "c_mktsegment", by="freq", first="AUTOMOBILE"))
    return out.select("c_custkey", *sorted(x for x in out.columns if x != "c_custkey"))


def _summary_sql():
    parts = []
    for col, num in [("c_custkey", True), ("c_name", False), ("c_nationkey", True),
                     ("c_acctbal", True), ("c_mktsegment", False)]:
        if num:
            stats = (f"CAST(min({col}) AS DOUBLE), CAST(max({col}) AS DOUBLE), round(avg({col}), 6), "
                     f"round(stddev_samp({col}), 6), "
                     + ", ".join(f"round(quantile_cont(CAST({col} AS DOUBLE), {q}), 6)" for q in (0.25, 0.5, 0.75)))
        else:
            stats = ", ".join(["CAST(NULL AS DOUBLE)"] * 7)
        parts.append(f"SELECT '{col}' AS column_name, count({col}) AS n, count(*) - count({col}) AS n_missing, "
                     f"{stats} FROM customer")
    body = " UNION ALL ".join(parts)
    return f"SELECT * FROM ({body}) AS t(column_name, n, n_missing, min, max, mean, sd, q1, median, q3)"


@register("frame_summary", _summary_sql())
def frame_summary_q(spark, sf_dir):
    """AGG7: per-column summary with exact quartiles."""
    return frame_summary(_t(spark, sf_dir, "customer"))


@register("frame_levels", """
SELECT 'c_mktsegment' AS column_name, c_mktsegment AS level, count(*) AS n FROM customer GROUP BY 2
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2
UNION ALL SELECT 'big', CASE WHEN nullif(c_custkey % 3, 0) IS NULL THEN NULL
                             WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END, count(*) FROM customer GROUP BY 2""")
def frame_levels(spark, sf_dir):
    """AGG7: level counts of the factor and logical columns, missing ones too."""
    c = _t(spark, sf_dir, "customer")
    c = c.withColumn("big", F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal") > 5000))
    return level_summary(c, ["c_mktsegment", "c_nationkey", "big"])


@register("edit_by_type", """
SELECT p_partkey, p_size, lower(p_name) AS p_name, lower(p_brand) AS p_brand,
       coalesce(CASE WHEN p_partkey % 4 <> 0 THEN p_size > 20 END, false) AS large,
       coalesce(CASE WHEN p_partkey % 5 <> 0 THEN p_type = 'PROMO' END, false) AS promo
FROM part""")
def edit_by_type(spark, sf_dir):
    """PRJ6: one function on every column of a type, whatever its name: missing
    logicals become FALSE, texts lower case, numbers stay."""
    p = _t(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_name", "p_brand",
        F.when(F.col("p_partkey") % 4 != 0, F.col("p_size") > 20).alias("large"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_type") == "PROMO").alias("promo"))
    p = map_type(p, T.BooleanType, lambda c: F.coalesce(c, F.lit(False)))
    return map_type(p, T.StringType, F.lower)


# --- models (PL22-PL24) ---------------------------------------------------------

def model_frame(spark, sf_dir):
    """Fixture analysis frame: one row per line, logical/factor/numeric terms."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_linestatus") == "O").alias("outcome"),
        (F.col("l_returnflag") == "R").alias("flag_r"),
        F.col("l_returnflag").alias("flag"),
        (F.col("l_discount") > 0.05).alias("disc_hi"),
        (F.col("l_tax") > 0.04).alias("tax_hi"),
        F.col("l_quantity").alias("qty"),
        (F.col("l_shipdate") > F.lit(dt.datetime(1998, 1, 1)).cast("timestamp_ntz")).alias("ship_late"),
    )


def _or_2x2_sql(where: str = "TRUE") -> str:
    return f"""
WITH t AS (SELECT l_linestatus = 'O' AS y, l_returnflag = 'R' AS x FROM lineitem WHERE {where}),
c AS (SELECT CAST(sum(CASE WHEN y AND x THEN 1 ELSE 0 END) AS DOUBLE) AS a,
             CAST(sum(CASE WHEN NOT y AND x THEN 1 ELSE 0 END) AS DOUBLE) AS b,
             CAST(sum(CASE WHEN y AND NOT x THEN 1 ELSE 0 END) AS DOUBLE) AS c,
             CAST(sum(CASE WHEN NOT y AND NOT x THEN 1 ELSE 0 END) AS DOUBLE) AS d FROM t),
e AS (SELECT '(Intercept)' AS term, ln(c / d) AS b, sqrt(1 / c + 1 / d) AS se FROM c
      UNION ALL SELECT 'flag_rTRUE', ln(a * d / (b * c)), sqrt(1 / a + 1 / b + 1 / c + 1 / d) FROM c)
""" + TABLE_SQL


def _wald_table(lf, spark):
    return or_table(lf, spark, conf="wald", digits=6)


@register("or_table_binary", _or_2x2_sql())
def or_table_binary(spark, sf_dir):
    """ST1 + ST2: binary outcome on one logical term; odds ratios, p-values and
    Wald limits (the profile form is ``or_table_profile``)."""
    lf = fit(build_design(model_frame(spark, sf_dir), "outcome", ["flag_r"]))
    return _wald_table(lf, spark)


@register("or_table_factor", f"""
WITH g AS (SELECT l_returnflag AS lv, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS y1,
                  CAST(sum(CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END) AS DOUBLE) AS y0
           FROM lineitem GROUP BY 1),
base AS (SELECT * FROM g WHERE lv = 'A'),
e AS (SELECT '(Intercept)' AS term, ln(y1 / y0) AS b, sqrt(1 / y1 + 1 / y0) AS se FROM base
      UNION ALL
      SELECT 'flag' || g.lv, ln((g.y1 / g.y0) / (base.y1 / base.y0)),
             sqrt(1 / g.y1 + 1 / g.y0 + 1 / base.y1 + 1 / base.y0) FROM g, base WHERE g.lv <> 'A')
""" + TABLE_SQL)
def or_table_factor(spark, sf_dir):
    """ST1 + ST2 + CAT4: a 3-level factor term, first level baseline."""
    lf = fit(build_design(model_frame(spark, sf_dir), "outcome", ["flag"]))
    return _wald_table(lf, spark)


@register("or_table_subset", _or_2x2_sql("NOT (l_discount > 0.05)"))
def or_table_subset(spark, sf_dir):
    """ST8 + FLT11: the model refitted on the rows where a logical is FALSE."""
    mf = model_frame(spark, sf_dir).filter(~F.col("disc_hi"))
    lf = fit(build_design(mf, "outcome", ["flag_r"]))
    return _wald_table(lf, spark)


def _two_term_sql() -> str:
    """Newton steps on the four cells of two logical terms (y, n per cell),
    each solved by Cramer's rule, then the table."""
    p = "(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))))"
    sums = (f"sum(n * {p} * (1 - {p})) AS s00, sum(n * {p} * (1 - {p}) * x1) AS s01, "
            f"sum(n * {p} * (1 - {p}) * x2) AS s02, sum(n * {p} * (1 - {p}) * x1 * x2) AS s12, "
            f"sum(y - n * {p}) AS g0, sum((y - n * {p}) * x1) AS g1, sum((y - n * {p}) * x2) AS g2")
    det = "(s00 * (s01 * s02 - s12 * s12) - s01 * (s01 * s02 - s12 * s02) + s02 * (s01 * s12 - s01 * s02))"
    inv = {"00": "(s01 * s02 - s12 * s12)", "01": "(s02 * s12 - s01 * s02)", "02": "(s01 * s12 - s02 * s01)",
           "11": "(s00 * s02 - s02 * s02)", "12": "(s01 * s02 - s00 * s12)", "22": "(s00 * s01 - s01 * s01)"}
    step = [f"({inv['00']} * g0 + {inv['01']} * g1 + {inv['02']} * g2) / {det}",
            f"({inv['01']} * g0 + {inv['11']} * g1 + {inv['12']} * g2) / {det}",
            f"({inv['02']} * g0 + {inv['12']} * g1 + {inv['22']} * g2) / {det}"]
    return f"""
WITH RECURSIVE cell AS (
  SELECT CAST(l_returnflag = 'R' AS INTEGER) AS x1, CAST(l_discount > 0.05 AS INTEGER) AS x2,
         CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n
  FROM lineitem GROUP BY 1, 2),
it(i, b0, b1, b2) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
  UNION ALL
  SELECT i + 1, b0 + {step[0]}, b1 + {step[1]}, b2 + {step[2]}
  FROM (SELECT i, b0, b1, b2, {sums} FROM it, cell WHERE i < 30 GROUP BY i, b0, b1, b2)),
fin AS (SELECT b0, b1, b2, {sums} FROM it, cell WHERE i = 30 GROUP BY b0, b1, b2),
e AS (SELECT '(Intercept)' AS term, b0 AS b, sqrt({inv['00']} / {det}) AS se FROM fin
      UNION ALL SELECT 'flag_rTRUE', b1, sqrt({inv['11']} / {det}) FROM fin
      UNION ALL SELECT 'disc_hiTRUE', b2, sqrt({inv['22']} / {det}) FROM fin)
""" + TABLE_SQL


@register("or_table_two", _two_term_sql())
def or_table_two(spark, sf_dir):
    """ST1 + ST2, two terms; full table with p-values and Wald limits."""
    lf = fit(build_design(model_frame(spark, sf_dir), "outcome", ["flag_r", "disc_hi"]))
    return _wald_table(lf, spark)


_CELLS = """SELECT {x}, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS y,
  CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL"""
_PROFILE = profile_ctes("two", _CELLS.format(
    x="CAST(l_returnflag = 'R' AS DOUBLE) AS x1, CAST(l_discount > 0.05 AS DOUBLE) AS x2"), ["flag_r", "disc_hi"], None, _p_sql)


@register("or_table_profile", "WITH RECURSIVE " + " ".join(_PROFILE))
def or_table_profile(spark, sf_dir):
    """ST3: profile-likelihood limits (the tidy default for GLMs), rounded
    to 3 digits as the report does."""
    lf = fit(build_design(model_frame(spark, sf_dir), "outcome", ["flag_r", "disc_hi"]))
    return or_table(lf, spark, conf="profile", digits=3)


STEP_TERMS = ["flag", "disc_hi", "tax_hi", "qty", "ship_late"]


@register("stepwise_terms", backward_sql(_CELLS.format(
    x="CAST(l_returnflag = 'N' AS DOUBLE) AS x1, CAST(l_returnflag = 'R' AS DOUBLE) AS x2, "
      "CAST(l_discount > 0.05 AS DOUBLE) AS x3, CAST(l_tax > 0.04 AS DOUBLE) AS x4, CAST(l_quantity AS DOUBLE) AS x5, "
      "CAST(l_shipdate > TIMESTAMP '1998-01-01' AS DOUBLE) AS x6"),
    [("flag", ["flagN", "flagR"]), ("disc_hi", ["disc_hiTRUE"]), ("tax_hi", ["tax_hiTRUE"]), ("qty", ["qty"]),
     ("ship_late", ["ship_lateTRUE"])], _p_sql))
def stepwise_terms(spark, sf_dir):
    """ST4: backward AIC search over whole terms on one fixed row set, then
    the odds-ratio table of the kept model (Wald limits)."""
    d = build_design(model_frame(spark, sf_dir), "outcome", STEP_TERMS)
    lf = backward_aic(d)
    return or_table(lf, spark, conf="wald", digits=3)


@register("or_table_absorbed", absorbed_sql(_CELLS.format(
    x="CAST(l_suppkey AS VARCHAR) AS lv, CAST(l_discount > 0.05 AS DOUBLE) AS x1, CAST(l_tax > 0.04 AS DOUBLE) AS x2"),
    ["disc_hi", "tax_hi"]))
def or_table_absorbed(spark, sf_dir):
    """ST1 with a factor of as many levels as there are suppliers: log odds
    against the first level, and the other terms, without a column per level."""
    li = _t(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("supplier"), (F.col("l_linestatus") == "O").alias("outcome"),
        (F.col("l_discount") > 0.05).alias("disc_hi"), (F.col("l_tax") > 0.04).alias("tax_hi"))
    lf = fit_absorbed(li, "outcome", "supplier", ["disc_hi", "tax_hi"])
    terms = spark.createDataFrame(list(zip(lf.labels, lf.coef, lf.se)), "term string, estimate double, std_error double")
    table = lf.levels.filter("estimate is not null").select(F.col("level").alias("term"), "estimate", "std_error")
    return table.unionByName(terms).select("term", F.round("estimate", 6).alias("estimate"), F.round("std_error", 6).alias("std_error"))


# --- propensity and matching (PL19) ---------------------------------------------

@register("propensity_score", """
SELECT c_custkey AS person_id, c_mktsegment = 'AUTOMOBILE' AS treat,
       CAST(round(avg(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1.0 ELSE 0.0 END)
                  OVER (PARTITION BY c_nationkey), 6) AS DOUBLE) AS score
FROM customer""")
def propensity_score(spark, sf_dir):
    """ST5: saturated model (one factor) -- the score equals the group rate."""
    c = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("person_id"), (F.col("c_mktsegment") == "AUTOMOBILE").alias("treat"),
        F.col("c_nationkey").cast("string").alias("nation"))
    s = propensity(c, "treat", ["nation"])
    return s.select("person_id", "treat", F.round("score", 6).alias("score"))


MATCH_CASES = """
cs AS (SELECT s_suppkey AS id, s_acctbal AS score, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS prio
       FROM supplier WHERE s_nationkey < 6),
ct AS (SELECT s_suppkey AS id, s_acctbal AS score FROM supplier WHERE s_nationkey >= 6)"""


def _supplier_frame(spark, sf_dir):
    s = _t(spark, sf_dir, "supplier")
    return s.select("s_suppkey", "s_acctbal", (F.col("s_nationkey") < 6).alias("treat"))


@register("match_nearest_replace", "WITH " + MATCH_CASES + """,
p AS (SELECT cs.id AS case_id, ct.id AS control_id, abs(ct.score - cs.score) AS dist,
             row_number() OVER (PARTITION BY cs.id ORDER BY abs(ct.score - cs.score), ct.id) AS k FROM cs, ct)
SELECT case_id, control_id, CAST(k AS INTEGER) AS round, round(dist, 6) AS dist FROM p WHERE k <= 2""")
def match_nearest_replace(spark, sf_dir):
    """ST6 with replacement: each case's two nearest controls (exact k-NN by
    equi-joins on control ranks)."""
    pr = match_pairs(_supplier_frame(spark, sf_dir), "treat", "s_acctbal", "s_suppkey", ratio=2, replace=True)
    return pr.select("case_id", "control_id", "round", F.round("dist", 6).alias("dist"))


#: serial greedy matching of cs (id, score, prio) with ct (id, score), two rounds, and the weights w
GREEDY = """
nc AS (SELECT count(*) AS n FROM cs),
m(i, used, case_id, control_id) AS (
  SELECT 0, CAST([] AS BIGINT[]), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  UNION ALL
  SELECT m.i + 1, CASE WHEN pick.cid IS NULL THEN m.used ELSE list_append(m.used, pick.cid) END, cs.id, pick.cid
  FROM m JOIN nc ON m.i < 2 * nc.n
  JOIN cs ON cs.prio = (m.i % nc.n) + 1
  LEFT JOIN LATERAL (SELECT arg_min(ct.id, (abs(ct.score - cs.score), ct.id)) AS cid FROM ct
                     WHERE NOT list_contains(m.used, ct.id)) pick ON true),
pairs AS (SELECT case_id, control_id FROM m WHERE i > 0 AND control_id IS NOT NULL),
per AS (SELECT case_id, count(*) AS k FROM pairs GROUP BY 1),
raw AS (SELECT p.control_id AS id, p.case_id AS subclass, CAST(1.0 AS DOUBLE) / per.k AS r
        FROM pairs p JOIN per USING (case_id)),
tot AS (SELECT count(*) AS n, sum(r) AS s FROM raw),
w AS (SELECT case_id AS id, case_id AS subclass, CAST(1.0 AS DOUBLE) AS weights FROM per
      UNION ALL SELECT raw.id, raw.subclass, CAST(round(raw.r * tot.n / tot.s, 6) AS DOUBLE) FROM raw, tot)"""


@register("match_ratio2", "WITH RECURSIVE " + MATCH_CASES + "," + GREEDY + """
SELECT s.s_suppkey, s.s_acctbal, s.s_nationkey < 6 AS treat, w.subclass, w.weights, s.s_acctbal AS distance
FROM supplier s JOIN w ON w.id = s.s_suppkey""")
def match_ratio2(spark, sf_dir):
    """PL19 / ST6 + ST7: 2:1 nearest matching without replacement, matched
    rows with subclass, weights and distance."""
    df = _supplier_frame(spark, sf_dir)
    pairs = match_pairs(df, "treat", "s_acctbal", "s_suppkey", ratio=2)
    return matched_rows(df, pairs, "treat", "s_acctbal", "s_suppkey").select(
        "s_suppkey", "s_acctbal", "treat", "subclass", "weights", "distance")


#: the two sheets: columns by position, texts and 0/1 codes; the second one's rows without an age are left out
_SHEETS = {"key": "CAST(s_suppkey AS {text})", "sex": "CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END",
           "age": "CASE WHEN s_nationkey < 6 OR s_suppkey % 11 <> 0 THEN floor(30 + s_acctbal / 250) END",
           "chf": "s_suppkey % 3", "dm": "s_nationkey % 2",
           "indication": "CASE s_suppkey % 5 WHEN 0 THEN 'acute' WHEN 1 THEN 'planned' ELSE 'stable' END",
           "approach": "CASE WHEN s_suppkey % 7 < 3 THEN 'wrist' ELSE 'groin' END"}
MATCH_TERMS = ["sex", "age", "chf", "dm", "indication", "approach"]


def _propensity_sql() -> str:
    x = ["CAST(sex = 'M' AS DOUBLE)", "age", "CAST(chf = 1 AS DOUBLE)", "CAST(dm = 1 AS DOUBLE)",
         "CAST(indication = 'planned' AS DOUBLE)", "CAST(indication = 'stable' AS DOUBLE)", "CAST(approach = 'wrist' AS DOUBLE)"]
    cols = ", ".join(f"{e.replace('{text}', 'VARCHAR')} AS {n}" for n, e in _SHEETS.items())
    return f"""WITH RECURSIVE sheet AS (SELECT s_suppkey, s_nationkey < 6 AS treat, {cols} FROM supplier),
df AS (SELECT s_suppkey, treat, {', '.join(f'{e} AS x{i}' for i, e in enumerate(x, 1))} FROM sheet WHERE treat OR age IS NOT NULL),
{newton_ctes("ps", "SELECT *, CAST(treat AS DOUBLE) AS y, CAST(1 AS DOUBLE) AS n FROM df", 1 + len(x))},
scored AS (SELECT s_suppkey, treat, round(1 / (1 + exp(-(b0 + {' + '.join(f'b{i} * x{i}' for i in range(1, 1 + len(x)))}))), 9) AS ps
           FROM df, ps_fin),
cs AS (SELECT s_suppkey AS id, ps AS score, row_number() OVER (ORDER BY ps DESC, s_suppkey) AS prio FROM scored WHERE treat),
ct AS (SELECT s_suppkey AS id, ps AS score FROM scored WHERE NOT treat),""" + GREEDY + """
SELECT s.s_suppkey, s.treat, w.subclass, w.weights, round(s.ps, 6) AS distance FROM scored s JOIN w ON w.id = s.s_suppkey"""


def _sheet(spark, sf_dir, cond: str):
    s = _t(spark, sf_dir, "supplier").filter(cond)
    path = scratch_path(spark, "match-sheet")
    write_table(s.selectExpr(*[f"{e.replace('{text}', 'STRING')} AS `Column {i}`" for i, e in enumerate(_SHEETS.values())]), path, fmt="csv")
    kinds = {"age": "double", "chf": "int", "dm": "int"}
    return read_positional(spark, path, [(n, kinds.get(n, "string")) for n in _SHEETS])


@register("match_propensity", _propensity_sql())
def match_propensity(spark, sf_dir):
    """PL19 end to end: two sheets read by position and stacked by name (the
    second without rows that lack an age), 0/1 codes made logical, propensity
    on six covariates (ST5), 2:1 nearest matching on that score without
    replacement (ST6), matched rows with subclass, weights and the score as
    distance (ST7)."""
    one = _sheet(spark, sf_dir, "s_nationkey < 6").withColumn("treat", F.lit(True))
    two = _sheet(spark, sf_dir, "s_nationkey >= 6").filter(F.col("age").isNotNull()).withColumn("treat", F.lit(False))
    df = map_columns(stack_by_name([one, two]), ["chf", "dm"], is_one).withColumn("s_suppkey", F.col("key").cast("long"))
    # equal covariates have equal scores, whatever the order of the sums
    scored = propensity(df, "treat", MATCH_TERMS, out="ps").withColumn("ps", F.round("ps", 9))
    pairs = match_pairs(scored, "treat", "ps", "s_suppkey", ratio=2)
    return matched_rows(scored, pairs, "treat", "ps", "s_suppkey").select(
        "s_suppkey", "treat", "subclass", "weights", F.round("distance", 6).alias("distance"))

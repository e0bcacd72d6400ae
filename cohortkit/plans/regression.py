"""The analysis frame (PL21) and the models on it (PL22-PL24).

The study reads one wide sheet by position: blanks are missing, logicals are
words.  The fixture's sheet is an order survey, one row per order, with 52
columns; each is an expression over ``orders`` that means the same in Spark
and DuckDB, so the oracle builds the same frame.  ``u(k)`` is a fixed
pseudo-random share of the order key in [0, 1).

Roles: ``express`` is the treatment, ``returned`` and ``complaint`` are the
two outcomes, ``packaging`` is a device code with 0 for none, the carriers
and origins are logicals folded to one factor each, ``refunds`` is a count
that can be zero or missing.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import fill, first_true, present, title_case, to_missing
from ..operators.frames import map_columns
from ..operators.recode import level_tables
from ..session import cut_lineage, scratch_path
from ..sources.sinks import write_table
from ..sources.tables import load, read_positional
from ..stats.glm import build_design, fit, or_table
from ..stats.step import backward_aic
from .analysis import TABLE_SQL, _p_sql
from .newton_sql import profile_ctes
from .registry import register


def u(k: int) -> str:
    return f"(((o_orderkey * {7919 + 2 * k} + {104729 * k}) % 10007 + 10007) % 10007) / CAST(10007 AS DOUBLE)"


def _yes(k: int, share: str, missing: str | None = None) -> str:
    yes = f"({u(k)} < {share})"
    return yes if missing is None else f"CASE WHEN {u(k + 100)} >= {missing} THEN {yes} END"


ORIGINS = ["africa", "america", "asia", "europe", "middle_east"]
CARRIERS = ["rail", "road", "sea"]
#: logicals in which a blank means no
BLANK_IS_NO = ["insured", "fragile", "coupon", "tracked"]
HABITS = ["weekend", "holiday", "gift", "corporate", "loyalty", "repeat_buyer", "discount", "prepaid", "invoiced"]
HANDLING = ["cold", "bulky", "hazard", "rush", "split_ship", "back_order", "reweighed", "relabelled", "audited", "exported",
            "duty_paid", "signed_for", "hand_checked", "left_at_door", "delayed", "damaged", "partial", "cancelled"]

_EXPRESS, _RUSH, _DISCOUNT = _yes(1, "0.3"), _yes(33, "0.1"), _yes(26, "0.3")
_TENURE = f"floor(1 + 30 * {u(3)})"
_RISK = (f"0.06 + CASE WHEN {_EXPRESS} THEN 0.15 ELSE 0 END + CASE WHEN {_TENURE} > 20 THEN 0.2 ELSE 0 END "
         f"+ CASE WHEN {_RUSH} THEN 0.2 ELSE 0 END + CASE WHEN {u(5)} < 0.15 THEN 0.25 ELSE 0 END")
_GRUMBLE = f"0.1 + CASE WHEN {_DISCOUNT} THEN 0.2 ELSE 0 END + CASE WHEN {u(17)} < 0.3 THEN 0.15 ELSE 0 END"

#: (name, type, expression), in the sheet's order
SHEET: list[tuple[str, str, str]] = [
    ("amount", "double", "o_totalprice"),
    ("tenure", "double", _TENURE),
    ("rating", "double", f"CASE WHEN {u(4)} > 0.1 THEN floor(10 * {u(4)}) END"),
    ("distance", "double", f"floor(5 + 900 * {u(6)})"),
    ("lead_days", "double", f"floor(1 + 20 * {u(7)})"),
    ("items", "double", f"CASE WHEN {u(8)} > 0.02 THEN floor(1 + 12 * {u(8)}) END"),
    ("refunds", "double", f"CASE WHEN {u(9)} < 0.15 THEN floor(20 * {u(9)}) WHEN {u(9)} < 0.6 THEN 0 END"),
    ("order_no", "string", "lpad(CAST(o_orderkey AS {text}), 10, '0')"),
    ("channel", "string", "CASE o_orderpriority WHEN '1-URGENT' THEN 'phone' WHEN '2-HIGH' THEN 'shop' "
                          "WHEN '3-MEDIUM' THEN 'web' ELSE 'letter' END"),
    ("packaging", "string", f"CASE WHEN {u(5)} < 0.1 THEN 'crate' WHEN {u(5)} < 0.15 THEN 'pallet' WHEN {u(5)} < 0.8 THEN '0' END"),
    ("express", "boolean", _EXPRESS),
    ("returned", "boolean", f"({u(40)} < {_RISK})"),
    ("complaint", "boolean", f"({u(41)} < {_GRUMBLE})"),
    *((f"from_{n}", "boolean", f"(o_custkey % 7 = {i})") for i, n in enumerate(ORIGINS)),
    *((f"by_{n}", "boolean", f"({u(17 + i)} < 0.3)") for i, n in enumerate(CARRIERS)),
    *((n, "boolean", _yes(20 + i, "0.3")) for i, n in enumerate(HABITS)),
    *((n, "boolean", _yes(30 + i if i < 10 else 40 + i, "0.1")) for i, n in enumerate(HANDLING)),
    *((n, "boolean", _yes(60 + i, "0.25", "0.2")) for i, n in enumerate(BLANK_IS_NO)),
]
assert len(SHEET) == 52
CARRIER_LABELS = [(f"by_{n}", n) for n in CARRIERS]
ORIGIN_LABELS = [(f"from_{n}", n) for n in ORIGINS]
FACTORS = ["packaging", "channel", "carrier", "origin"]

SHEET_SQL = "sheet AS (SELECT " + ", ".join(
    f"CAST({e.replace('{text}', 'VARCHAR')} AS {dict(string='VARCHAR', boolean='BOOLEAN', double='DOUBLE')[t]}) AS {n}"
    for n, t, e in SHEET) + " FROM orders)"


def _label_sql(pairs) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{v.replace('_', ' ').title()}'" for c, v in pairs) + " END"


_KEPT = [n for n, _, _ in SHEET if n not in BLANK_IS_NO and n not in ("packaging", "channel")]
FRAME_SQL = f"""WITH RECURSIVE {SHEET_SQL},
frame AS (SELECT {', '.join(_KEPT)}, {', '.join(f'coalesce({n}, FALSE) AS {n}' for n in BLANK_IS_NO)},
                 upper(coalesce(nullif(packaging, '0'), 'none')) AS packaging, upper(channel) AS channel,
                 {_label_sql(ORIGIN_LABELS)} AS origin, coalesce({_label_sql(CARRIER_LABELS)}, 'None') AS carrier,
                 refunds > 0 AS refunded, nullif(packaging, '0') IS NOT NULL AS packed,
                 by_rail OR by_road OR by_sea AS carried FROM sheet)"""


def analysis_frame_df(spark, sf_dir):
    """The sheet written with its own header names, read back by position, and
    recoded: labels from logicals, blanks that mean no, code 0 as missing,
    presence flags before missing becomes "none", one spelling per text."""
    o = load(spark, sf_dir, "orders")
    path = scratch_path(spark, "sheet")
    write_table(o.select(*[F.expr(e.replace("{text}", "STRING")).alias(f"Column {i}")
                           for i, (_, _, e) in enumerate(SHEET)]), path, fmt="csv")
    f = read_positional(spark, path, [(n, t) for n, t, _ in SHEET])
    f = f.withColumns({"origin": first_true([(c, v.replace("_", " ")) for c, v in ORIGIN_LABELS]),
                       "carrier": first_true(CARRIER_LABELS), "refunded": F.col("refunds") > 0})
    f = map_columns(f, BLANK_IS_NO, lambda c: F.coalesce(c, F.lit(False)))
    f = f.withColumn("packaging", to_missing("packaging", "0"))
    f = f.withColumns({"packed": present("packaging"), "carried": present("carrier")})
    f = f.withColumns({c: fill(c, "none") for c in ("packaging", "carrier")})
    f = map_columns(f, ["packaging", "channel"], F.upper)
    return map_columns(f, ["carrier", "origin"], title_case)


@register("analysis_frame", FRAME_SQL + " SELECT * FROM frame")
def analysis_frame(spark, sf_dir):
    """PL21 / SRC3 + SRC4: 52 typed columns by position, blanks and logicals,
    and the recoded and derived columns."""
    return analysis_frame_df(spark, sf_dir)


@register("frame_factor_levels", FRAME_SQL + ", c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS level, count(*) AS n FROM frame WHERE {c} IS NOT NULL GROUP BY 2" for c in FACTORS) + """)
SELECT column_name, level, n, CAST(row_number() OVER (PARTITION BY column_name
       ORDER BY CASE WHEN column_name = 'carrier' AND level = 'None' THEN 0 ELSE 1 END, n DESC, level) AS INTEGER) AS position
FROM c""")
def frame_factor_levels(spark, sf_dir):
    """PL21 / CAT2 + CAT3: levels of the four factors by frequency, "None" first for the carrier, in one pass."""
    return level_tables(analysis_frame_df(spark, sf_dir), FACTORS, first={"carrier": "None"})


def _levels(frame, cols):
    every = level_tables(frame, cols, first={"carrier": "None"})
    return {c: every.filter(F.col("column_name") == c) for c in cols}


@register("frame_or_factor", FRAME_SQL + """,
lv AS (SELECT carrier AS level, CAST(count_if(complaint) AS DOUBLE) AS y1,
              CAST(count_if(NOT complaint) AS DOUBLE) AS y0 FROM frame GROUP BY 1),
base AS (SELECT * FROM lv WHERE level = 'None'),
e AS (SELECT '(Intercept)' AS term, ln(y1 / y0) AS b, sqrt(1 / y1 + 1 / y0) AS se FROM base
      UNION ALL SELECT 'carrier' || lv.level, ln((lv.y1 / lv.y0) / (base.y1 / base.y0)),
                       sqrt(1 / lv.y1 + 1 / lv.y0 + 1 / base.y1 + 1 / base.y0)
      FROM lv, base WHERE lv.level <> 'None')
""" + TABLE_SQL)
def frame_or_factor(spark, sf_dir):
    """PL23: the second outcome on the carrier; the level moved first is the baseline."""
    f = analysis_frame_df(spark, sf_dir)
    lf = fit(build_design(f, "complaint", ["carrier"], _levels(f, ["carrier"])))
    return or_table(lf, spark, conf="wald", digits=6)


#: models with profile limits: first outcome on single terms and on two, second outcome on single terms
SINGLE = {"first": [("returned", ["express"]), ("returned", ["packed"]), ("returned", ["rush"]), ("returned", ["express", "packed"])],
          "second": [("complaint", ["express"]), ("complaint", ["insured"]), ("complaint", ["carried"])]}


def _profile_sql(models) -> str:
    parts = []
    for i, (y, terms) in enumerate(models):
        x = ", ".join(f"CAST({t} AS DOUBLE) AS x{k}" for k, t in enumerate(terms, 1))
        cells = f"SELECT {x}, CAST(count_if({y}) AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n FROM frame GROUP BY ALL"
        parts.append(profile_ctes(f"m{i}", cells, terms, f"{y} ~ {' + '.join(terms)}", _p_sql))
    return FRAME_SQL + "," + ",".join(c for c, _ in parts) + " " + " UNION ALL ".join(q for _, q in parts)


def _profile_tables(spark, sf_dir, models):
    used = sorted({c for y, terms in models for c in [y, *terms]})
    f = cut_lineage(analysis_frame_df(spark, sf_dir).select(used))            # the models read the sheet once
    out = None
    for y, terms in models:
        t = or_table(fit(build_design(f, y, terms)), spark).select(F.lit(f"{y} ~ {' + '.join(terms)}").alias("model"), "*")
        out = t if out is None else out.unionByName(t)
    return out


@register("frame_or_profile", _profile_sql(SINGLE["first"]))
def frame_or_profile(spark, sf_dir):
    """PL22: the first outcome on single terms and on two, odds ratios with profile limits."""
    return _profile_tables(spark, sf_dir, SINGLE["first"])


@register("frame_or_profile_second", _profile_sql(SINGLE["second"]))
def frame_or_profile_second(spark, sf_dir):
    """PL23: the second outcome on single terms, odds ratios with profile limits."""
    return _profile_tables(spark, sf_dir, SINGLE["second"])


MODEL_TERMS = ["express", "origin", "tenure", "rating", "gift", "corporate", "cold", "bulky", "rush", "packed", "channel",
               "distance", "insured", "carrier", "refunded"]


def subset_search(spark, sf_dir):
    """PL24: rows where a logical is FALSE, then the backward search (ST4, ST8) without that term."""
    f = analysis_frame_df(spark, sf_dir).filter(~F.col("packed"))
    terms = [t for t in MODEL_TERMS if t not in ("packed", "refunded", "carrier")] + ["carried"]
    return backward_aic(build_design(f, "returned", terms, _levels(f, ["origin", "channel"])))


@register("frame_step_subset")
def frame_step_subset(spark, sf_dir):
    """PL24: odds ratios of the terms that the backward search keeps."""
    return or_table(subset_search(spark, sf_dir), spark, conf="wald", digits=3)


def rated_search(spark, sf_dir, outcome="returned", terms=MODEL_TERMS):
    """PL22/PL23: the search on the rows that have the numeric that is missing elsewhere."""
    f = analysis_frame_df(spark, sf_dir).filter(present("rating"))
    factors = [t for t in ("origin", "channel", "carrier", "packaging") if t in terms]
    return backward_aic(build_design(f, outcome, terms, _levels(f, factors)))


@register("frame_step_device")
def frame_step_device(spark, sf_dir):
    """PL22: the search with the device's type in place of its presence."""
    return or_table(rated_search(spark, sf_dir, "returned", [t if t != "packed" else "packaging" for t in MODEL_TERMS]),
                    spark, conf="wald", digits=3)


@register("frame_step_second")
def frame_step_second(spark, sf_dir):
    """PL23: the search for the second outcome."""
    terms = ["discount" if t == "refunded" else "carried" if t == "carrier" else t for t in MODEL_TERMS if t != "distance"]
    return or_table(rated_search(spark, sf_dir, "complaint", terms), spark, conf="wald", digits=3)

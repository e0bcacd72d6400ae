"""Extraction layer (PL1-PL9): cohort and per-topic facts, as Spark plans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions.text import flag_text
from ..functions.timeops import age_years, local_day, local_to_utc, prompt_window, utc_to_local
from ..operators.cohort import CohortSpec, build_cohort, by_ids, code_set, tag_groups
from ..operators.lookup import attach_alias, attach_display
from ..operators.picks import first_by, max_at_first, max_at_first_many
from ..operators.predicates import any_of, between, current_rows, in_codes, matches
from ..operators.windows import events_around, events_before
from ..sources.roles import FIN, LISTING, letter_code, regions
from .common import SPEC, TZ, cohort, roles, with_cohort, with_roles
from .registry import register


# --- PL1 building blocks ------------------------------------------------------

@register("icd_dimension", with_cohort("SELECT nomenclature_id FROM icd"))
def icd_dimension(spark, sf_dir):
    return code_set(roles(spark, sf_dir).nomenclature, SPEC.code_pattern, SPEC.vocabulary)


@register("cohort_by_procedure", with_cohort("SELECT * FROM pts"))
def cohort_by_procedure(spark, sf_dir):
    return cohort(spark, sf_dir)[0]


@register("cohort_by_ids", with_cohort("SELECT * FROM listed"))
def cohort_by_ids(spark, sf_dir):
    return cohort(spark, sf_dir)[1]


@register("cohort_by_id_table", with_roles("""
SELECT DISTINCT e.encntr_id, e.person_id, e.reg_dt_tm, 'LISTED' AS pt_group
FROM enc e WHERE e.person_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')"""))
def cohort_by_id_table(spark, sf_dir):
    """Listed cohort whose id list is a table that grows with the data
    (left-semi join path of PRM1 instead of an inlined IN list)."""
    r = roles(spark, sf_dir)
    ids = r.table("customer").filter(F.col("c_mktsegment") == "AUTOMOBILE").select("c_custkey")
    return by_ids(r.encounter, r.alias, ids, "LISTED", alias_type=LISTING)


@register("cohort_union", with_cohort("SELECT * FROM allp"))
def cohort_union(spark, sf_dir):
    return cohort(spark, sf_dir)[2]


COHORT_TAG_SQL = with_cohort("""
SELECT a.encntr_id, a.person_id, e.encntr_type_class_cd, cv.display AS encounter_class,
       a.reg_dt_tm, e.disch_dt_tm, c.pt_group
FROM allp a LEFT JOIN listed c ON a.encntr_id = c.encntr_id
JOIN enc e ON a.encntr_id = e.encntr_id
LEFT JOIN cv ON cv.code = ascii(e.encntr_type_class_cd) - 65""")


def cohort_group_tag_df(spark, sf_dir):
    """PL1: the union cohort with the listed group's label, class and its display, times."""
    r = roles(spark, sf_dir)
    _, listed, allp = cohort(spark, sf_dir)
    out = tag_groups(allp, listed, r.encounter, ("encntr_type_class_cd", "disch_dt_tm"))
    out = attach_display(out, r.code_value, letter_code("encntr_type_class_cd"), "encounter_class")
    return out.select("encntr_id", "person_id", "encntr_type_class_cd", "encounter_class", "reg_dt_tm",
                      "disch_dt_tm", "pt_group")


register("cohort_group_tag", COHORT_TAG_SQL)(cohort_group_tag_df)


@register("role_views", with_roles("SELECT * FROM enc"))
def role_views(spark, sf_dir):
    return roles(spark, sf_dir).encounter


@register("tz_bounds", """
SELECT o_orderkey AS encntr_id, o_orderdate AS reg_dt_tm FROM orders
WHERE o_orderdate BETWEEN timezone('UTC', timezone('America/Chicago', TIMESTAMP '1996-01-01'))
                      AND timezone('UTC', timezone('America/Chicago', TIMESTAMP '1999-07-01'))""")
def tz_bounds(spark, sf_dir):
    """Window given at local midnight; bounds shifted to UTC as literals (SC1)."""
    enc = roles(spark, sf_dir).encounter
    lo = local_to_utc(dt.datetime(1996, 1, 1), TZ)
    hi = local_to_utc(dt.datetime(1999, 7, 1), TZ)
    return enc.filter(between("reg_dt_tm", lo, hi)).select("encntr_id", "reg_dt_tm")


# --- facts around the cohort --------------------------------------------------

# Fixed values of the fixture study: measure codes (event, unit).
WEIGHT = ("A", "F")
HEIGHT = ("N", "O")
BMI_EVENT = "R"                      # no unit filter for BMI (as in the study)
DRUG_CODES = (1, 2, 3, 4, 6)            # drugs searched
IV_EVENTS = ("A", "R")               # begin-bag / rate-change style events
TYPES_LISTED = ("PROMO", "STANDARD")  # diagnosis vocabularies listed


@register("current_rows", with_roles("""
SELECT event_id, person_id, event_cd, result_val, event_end_dt_tm FROM pev
WHERE valid_until_dt_tm > DATE '2099-12-31'"""))
def current_rows_q(spark, sf_dir):
    ev = current_rows(roles(spark, sf_dir).person_event)
    return ev.select("event_id", "person_id", "event_cd", "result_val", "event_end_dt_tm")


@register("first_measure_max", with_roles("""
, f AS (SELECT l.l_orderkey AS encntr_id, l.l_shipdate AS t, l.l_quantity AS v
        FROM lineitem l JOIN enc e ON e.encntr_id = l.l_orderkey WHERE l.l_shipdate <= e.disch_dt_tm),
r AS (SELECT encntr_id, v, dense_rank() OVER (PARTITION BY encntr_id ORDER BY t) AS dr FROM f)
SELECT encntr_id, max(v) AS first_val FROM r WHERE dr = 1 GROUP BY encntr_id"""))
def first_measure_max(spark, sf_dir):
    """AGG2 + FLT7: per encounter, the largest value at the earliest time,
    among events up to (and at) discharge."""
    r = roles(spark, sf_dir)
    facts = events_before(r.encounter_event, r.encounter, "encntr_id", "event_end_dt_tm",
                          "disch_dt_tm", strict=False)
    return max_at_first(facts, "encntr_id", "event_end_dt_tm", "result_val", "first_val")


@register("first_measure_row", with_roles("""
SELECT person_id, event_id, event_end_dt_tm, result_val FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY event_end_dt_tm NULLS LAST, event_id) AS rn
  FROM pev WHERE event_cd = 'purchase') WHERE rn = 1"""))
def first_measure_row(spark, sf_dir):
    """WIN1 + SRT1: whole first row per person by (time, event id)."""
    ev = roles(spark, sf_dir).person_event.filter(F.col("event_cd") == "purchase")
    return first_by(ev, "person_id", ["event_end_dt_tm", "event_id"]).select(
        "person_id", "event_id", "event_end_dt_tm", "result_val")


def _measures(enc, events, cohort_ids):
    """Weight, height and BMI of the cohort's encounters in one aggregate:
    current versions (FLT8), encounter and person both matching (JN7)."""
    facts = events_before(current_rows(events.join(cohort_ids, "encntr_id", "left_semi")), enc,
                          ["encntr_id", "person_id"], "event_end_dt_tm", "disch_dt_tm", strict=False)
    ev, un = F.col("event_cd"), F.col("result_units_cd")
    return max_at_first_many(facts, "encntr_id", "event_end_dt_tm", {
        "weight": ("result_val", (ev == WEIGHT[0]) & (un == WEIGHT[1])),
        "height": ("result_val", (ev == HEIGHT[0]) & (un == HEIGHT[1])),
        "bmi": ("result_val", ev == BMI_EVENT),
    })


def _rank_first_sql(name, cond):
    return (f"{name} AS (SELECT encntr_id, max(v) AS {name} FROM (SELECT *, dense_rank() OVER "
            f"(PARTITION BY encntr_id ORDER BY t) AS dr FROM m WHERE {cond}) WHERE dr = 1 GROUP BY encntr_id)")


AGE_SQL = ("CAST(trunc(epoch(timezone('America/Chicago', timezone('UTC', e.reg_dt_tm)) - p.birth_dt_tm)"
           " / 86400.0 / 365.25) AS INTEGER)")


# events of an encounter with their own person, current versions only
EVENTS_SQL = """
, evt AS (SELECT l.*, CASE WHEN l.l_linenumber = 6 THEN o.o_custkey + 1 ELSE o.o_custkey END AS person_id
          FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_linenumber <> 7)"""


@register("demographics", with_cohort(EVENTS_SQL + f"""
, m AS (SELECT l.l_orderkey AS encntr_id, l.l_returnflag AS ev, l.l_linestatus AS u, l.l_quantity AS v,
               l.l_shipdate AS t
        FROM evt l JOIN enc e ON e.encntr_id = l.l_orderkey AND e.person_id = l.person_id
        WHERE l.l_orderkey IN (SELECT encntr_id FROM allp) AND l.l_shipdate <= e.disch_dt_tm),
{_rank_first_sql('weight', "ev = 'A' AND u = 'F'")},
{_rank_first_sql('height', "ev = 'N' AND u = 'O'")},
{_rank_first_sql('bmi', "ev = 'R'")}
SELECT fin.fin, a.encntr_id, c.pt_group, cl.display AS encounter_class, {AGE_SQL} AS age,
       n.display AS race, sx.display AS sex, height.height, weight.weight, bmi.bmi
FROM allp a JOIN enc e ON e.encntr_id = a.encntr_id
JOIN per p ON p.person_id = a.person_id
LEFT JOIN fin ON fin.encntr_id = a.encntr_id
LEFT JOIN listed c ON c.encntr_id = a.encntr_id
LEFT JOIN cv n ON n.code = p.race_cd
LEFT JOIN cv sx ON sx.code = ascii(p.sex_cd) - 65
LEFT JOIN cv cl ON cl.code = ascii(e.encntr_type_class_cd) - 65
LEFT JOIN weight ON weight.encntr_id = a.encntr_id
LEFT JOIN height ON height.encntr_id = a.encntr_id
LEFT JOIN bmi ON bmi.encntr_id = a.encntr_id"""))
def demographics(spark, sf_dir):
    """PL2: cohort + outside number (JN10) + age at admission + first measures
    of the same encounter and person (JN7, FLT8) + a display per code (JN9)."""
    r = roles(spark, sf_dir)
    _, listed, allp = cohort(spark, sf_dir, materialize=True)   # used twice below
    base = (tag_groups(allp, listed, r.encounter, ("encntr_type_class_cd",))
            .join(r.person, "person_id"))
    base = base.withColumn("age", age_years("reg_dt_tm", "birth_dt_tm", TZ))
    base = attach_display(base, r.code_value, "race_cd", "race")
    base = attach_display(base, r.code_value, letter_code("sex_cd"), "sex")
    base = attach_display(base, r.code_value, letter_code("encntr_type_class_cd"), "encounter_class")
    meas = _measures(r.encounter, r.encounter_person_event, allp.select("encntr_id"))
    out = attach_alias(base.join(meas, "encntr_id", "left"), r.alias, FIN)
    return out.select("fin", "encntr_id", "pt_group", "encounter_class", "age", "race", "sex", "height", "weight", "bmi")


@register("age_at_admission", with_roles(f"""
SELECT e.encntr_id, {AGE_SQL} AS age FROM enc e JOIN per p ON p.person_id = e.person_id"""))
def age_at_admission(spark, sf_dir):
    """SC2 + SC5 + SC6 on every encounter."""
    r = roles(spark, sf_dir)
    j = r.encounter.join(r.person, "person_id")
    return j.select("encntr_id", age_years("reg_dt_tm", "birth_dt_tm", TZ).alias("age"))


FINAL_TYPE = "F"


@register("diagnosis_list", with_cohort("""
SELECT DISTINCT fin.fin, p.p_type AS code_type, ty.display AS code_type_name, p.p_brand AS code, p.p_name AS description,
       l.l_linenumber AS priority
FROM allp a JOIN lineitem l ON l.l_orderkey = a.encntr_id JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN fin ON fin.encntr_id = a.encntr_id LEFT JOIN cv ty ON ty.code = ascii(p.p_type) - 65
WHERE p.p_type IN ('PROMO', 'STANDARD') AND l.l_linestatus = 'F'"""))
def diagnosis_list(spark, sf_dir):
    """PL3: final cohort diagnoses with a listed vocabulary and its display
    (JN1, FLT5, FLT1, JN9), one row per outside number (JN10)."""
    r = roles(spark, sf_dir)
    allp = cohort(spark, sf_dir)[2].select("encntr_id")
    nomen = r.nomenclature.filter(F.col("source_vocabulary").isin(*TYPES_LISTED))
    nomen = attach_display(nomen, r.code_value, letter_code("source_vocabulary"), "code_type_name")
    diag = r.procedure.filter(F.col("diag_type_cd") == FINAL_TYPE).join(allp, "encntr_id", "left_semi")
    return (attach_alias(diag.join(nomen, "nomenclature_id"), r.alias, FIN)
            .select("fin", F.col("source_vocabulary").alias("code_type"), "code_type_name",
                    F.col("source_identifier").alias("code"), F.col("source_string").alias("description"),
                    "priority")
            .distinct())


def _proc_days(r, cohort_ids):
    """PL4-PL6 body: cohort procedures coded by pattern in one vocabulary
    (with its display), outside number, local day."""
    codes = r.nomenclature.filter(matches("source_identifier", SPEC.code_pattern)
                                  & (F.col("source_vocabulary") == SPEC.vocabulary))
    codes = attach_display(codes, r.code_value, letter_code("source_vocabulary"), "vocabulary")
    proc = r.procedure.join(cohort_ids, "encntr_id", "left_semi")
    return (attach_alias(proc.join(codes, "nomenclature_id"), r.alias, FIN)
            .select("fin", local_day("proc_dt_tm", TZ).alias("proc_day"),
                    F.col("source_identifier").alias("code"), F.col("source_string").alias("code_text"), "vocabulary")
            .distinct())


PROC_DAYS_SQL = """
SELECT DISTINCT fin.fin,
       CAST(timezone('America/Chicago', timezone('UTC', l.l_shipdate)) AS DATE) AS proc_day,
       p.p_brand AS code, p.p_name AS code_text, vo.display AS vocabulary
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey LEFT JOIN fin ON fin.encntr_id = l.l_orderkey
LEFT JOIN cv vo ON vo.code = ascii(p.p_type) - 65
WHERE regexp_matches(p.p_brand, '^Brand#[1-3]$') AND p.p_type = 'PROMO'
  AND l.l_orderkey IN (SELECT encntr_id FROM {src})"""


@register("tz_local_day", with_cohort(PROC_DAYS_SQL.format(src="allp")))
def tz_local_day(spark, sf_dir):
    """PL4: window from prompt text parsed by a mask (SC4), local procedure days."""
    r = roles(spark, sf_dir)
    window = prompt_window("01/01/1996", "07/01/1999", "MM/dd/yyyy")
    spec = CohortSpec(**{**SPEC.__dict__, "window": window})
    allp = build_cohort(r.encounter, r.procedure, r.nomenclature, r.alias, spec)[2]
    return _proc_days(r, allp.select("encntr_id"))


@register("tz_local_day_fixed", with_cohort("""
, pts_local AS (SELECT DISTINCT e.encntr_id, e.person_id, e.reg_dt_tm FROM enc e, icd, lineitem l
        WHERE e.reg_dt_tm BETWEEN timezone('UTC', timezone('America/Chicago', TIMESTAMP '1996-01-01'))
                              AND timezone('UTC', timezone('America/Chicago', TIMESTAMP '1999-07-01'))
          AND e.encntr_type_class_cd = 'F'
          AND e.encntr_id = l.l_orderkey AND l.l_partkey = icd.nomenclature_id),
allp_local AS (SELECT encntr_id, person_id, reg_dt_tm FROM listed UNION SELECT * FROM pts_local)
""" + PROC_DAYS_SQL.format(src="allp_local")))
def tz_local_day_fixed(spark, sf_dir):
    """PL5: fixed window at local midnight (PRM3 + SC1), local procedure days."""
    r = roles(spark, sf_dir)
    spec = CohortSpec(**{**SPEC.__dict__, "tz": TZ})
    allp = build_cohort(r.encounter, r.procedure, r.nomenclature, r.alias, spec)[2]
    return _proc_days(r, allp.select("encntr_id"))


@register("tz_local_day_listed", with_cohort(PROC_DAYS_SQL.format(src="listed")))
def tz_local_day_listed(spark, sf_dir):
    """PL6: listed cohort only."""
    r = roles(spark, sf_dir)
    listed = by_ids(r.encounter, r.alias, SPEC.ids, SPEC.group, alias_type=LISTING)
    return _proc_days(r, listed.select("encntr_id"))


@register("meds_given", with_cohort(EVENTS_SQL + """
SELECT DISTINCT fin.fin,
       timezone('America/Chicago', timezone('UTC', l.l_shipdate)) AS dose_datetime,
       md.display AS medication, l.l_quantity AS dose, du.display AS dose_unit,
       l.l_discount AS rate, ru.display AS rate_unit, iv.display AS iv_event,
       ro.display AS route
FROM allp a JOIN enc e ON e.encntr_id = a.encntr_id
JOIN evt l ON l.l_orderkey = e.encntr_id AND l.person_id = e.person_id
LEFT JOIN fin ON fin.encntr_id = a.encntr_id
LEFT JOIN cv md ON md.code = l.l_linenumber
LEFT JOIN cv du ON du.code = ascii(l.l_returnflag) - 65
LEFT JOIN cv ru ON ru.code = ascii(l.l_linestatus) - 65
LEFT JOIN cv iv ON iv.code = ascii(l.l_returnflag) - 65
LEFT JOIN cv ro ON ro.code = l.l_suppkey % 25
WHERE l.l_linenumber IN (1, 2, 3, 4, 6) AND l.l_shipdate < e.disch_dt_tm
  AND (l.l_quantity > 25 OR l.l_returnflag IN ('A', 'R'))"""))
def meds_given(spark, sf_dir):
    """PL7: drugs given before discharge (strict bound), dose > 0-style test OR
    an IV event (FLT5, FLT7, FLT9); current rows of the same encounter and
    person (FLT8, JN7); outside number, units, route and displays (JN10, JN9)."""
    r = roles(spark, sf_dir)
    allp = cohort(spark, sf_dir)[2].select("encntr_id")
    ev = in_codes(r.encounter_person_event.join(allp, "encntr_id", "left_semi"), "line_cd", DRUG_CODES)
    ev = current_rows(ev).filter(any_of([F.col("result_val") > 25, F.col("event_cd").isin(*IV_EVENTS)]))
    ev = events_before(ev, r.encounter, ["encntr_id", "person_id"], "event_end_dt_tm", "disch_dt_tm", strict=True)
    for code, out in (("line_cd", "medication"), (letter_code("event_cd"), "dose_unit"),
                      (letter_code("result_units_cd"), "rate_unit"), (letter_code("event_cd"), "iv_event"),
                      ("admin_route_cd", "route")):
        ev = attach_display(ev, r.code_value, code, out)
    ev = attach_alias(ev, r.alias, FIN)
    return ev.select("fin", utc_to_local("event_end_dt_tm", TZ).alias("dose_datetime"), "medication",
                     F.col("result_val").alias("dose"), "dose_unit", F.col("infusion_rate").alias("rate"), "rate_unit",
                     "iv_event", "route").distinct()


@register("vitals_around_procedure", with_cohort(EVENTS_SQL + """
, anc AS (SELECT l.l_orderkey AS encntr_id, l.l_shipdate AS at FROM lineitem l
          WHERE l.l_orderkey IN (SELECT encntr_id FROM listed)
            AND l.l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO'))
SELECT DISTINCT fin.fin, timezone('America/Chicago', timezone('UTC', f.l_shipdate)) AS event_datetime,
       cv.display AS event, f.l_quantity AS result, u.display AS result_units
FROM evt f JOIN enc e ON e.encntr_id = f.l_orderkey AND e.person_id = f.person_id
JOIN anc ON anc.encntr_id = f.l_orderkey
 AND f.l_shipdate BETWEEN anc.at - INTERVAL 12 HOUR AND anc.at + INTERVAL 1 DAY
LEFT JOIN fin ON fin.encntr_id = f.l_orderkey LEFT JOIN cv ON cv.code = ascii(f.l_returnflag) - 65
LEFT JOIN cv u ON u.code = ascii(f.l_linestatus) - 65
WHERE f.l_returnflag IN ('A', 'R')"""))
def vitals_around_procedure(spark, sf_dir):
    """PL8 of the listed cohort: current measurements of the encounter and its
    person from half a day before to a day after a coded procedure of the
    encounter (JN8, JN1, JN7, FLT8), with outside number, unit and display."""
    r = roles(spark, sf_dir)
    listed = by_ids(r.encounter, r.alias, SPEC.ids, None, alias_type=LISTING).select("encntr_id")
    codes = r.nomenclature.filter(F.col("source_vocabulary") == SPEC.vocabulary).select("nomenclature_id")
    anchors = (r.procedure.join(listed, "encntr_id", "left_semi").join(codes, "nomenclature_id", "left_semi"))
    people = r.encounter.join(listed, "encntr_id", "left_semi").select("encntr_id", "person_id")
    facts = current_rows(r.encounter_person_event.filter(F.col("event_cd").isin(*IV_EVENTS)))
    facts = facts.join(people, ["encntr_id", "person_id"], "left_semi")
    hit = events_around(facts, anchors, "encntr_id", "event_end_dt_tm", "proc_dt_tm", 0.5, 1.0)
    for code, out in ((letter_code("event_cd"), "event"), (letter_code("result_units_cd"), "result_units")):
        hit = attach_display(hit, r.code_value, code, out)
    hit = attach_alias(hit, r.alias, FIN)
    return hit.select("fin", utc_to_local("event_end_dt_tm", TZ).alias("event_datetime"), "event",
                      F.col("result_val").alias("result"), "result_units").distinct()


@register("events_around_anchor", with_roles("""
, anc AS (SELECT person_id, event_end_dt_tm AS at FROM pev WHERE event_cd = 'purchase'),
f AS (SELECT * FROM pev WHERE event_cd IN ('view', 'error') AND valid_until_dt_tm > DATE '2099-12-31')
SELECT DISTINCT f.person_id, f.event_id,
       timezone('America/Chicago', timezone('UTC', f.event_end_dt_tm)) AS event_datetime,
       f.event_cd, f.result_val
FROM f JOIN anc a ON a.person_id = f.person_id
 AND f.event_end_dt_tm BETWEEN a.at - INTERVAL 12 HOUR AND a.at + INTERVAL 1 DAY"""))
def events_around_anchor(spark, sf_dir):
    """PL8 / JN8: current view/error events within -12 h .. +1 day of any
    purchase of the same person, each event once."""
    ev = roles(spark, sf_dir).person_event
    anchors = ev.filter(F.col("event_cd") == "purchase")
    facts = current_rows(ev.filter(F.col("event_cd").isin("view", "error")))
    hit = events_around(facts, anchors, "person_id", "event_end_dt_tm", "event_end_dt_tm", 0.5, 1.0)
    return hit.select("person_id", "event_id", utc_to_local("event_end_dt_tm", TZ).alias("event_datetime"),
                      "event_cd", "result_val")


@register("surgery_list", with_cohort("""
SELECT DISTINCT c.encntr_id,
       timezone('America/Chicago', timezone('UTC', l.l_shipdate)) AS surgery_start,
       timezone('America/Chicago', timezone('UTC', l.l_shipdate + to_hours(l.l_linenumber))) AS surgery_stop,
       CASE l.l_linenumber WHEN 1 THEN 'TRUE' ELSE 'FALSE' END AS primary_procedure,
       l.l_partkey AS surg_proc_cd, p.p_name AS surgery
FROM listed c JOIN lineitem l ON l.l_orderkey = c.encntr_id JOIN part p ON p.p_partkey = l.l_partkey"""))
def surgery_list(spark, sf_dir):
    """PL9: surgeries of the listed cohort (JN11, JN1, SC2, SC7, JN9)."""
    r = roles(spark, sf_dir)
    listed = by_ids(r.encounter, r.alias, SPEC.ids, None, alias_type=LISTING).select("encntr_id")
    s = r.surgery.join(listed, "encntr_id", "left_semi")
    names = r.nomenclature.select(F.col("nomenclature_id").alias("surg_proc_cd"), F.col("source_string").alias("surgery"))
    s = s.join(names, "surg_proc_cd", "left")
    return s.select("encntr_id", utc_to_local("surg_start_dt_tm", TZ).alias("surgery_start"),
                    utc_to_local("surg_stop_dt_tm", TZ).alias("surgery_stop"),
                    flag_text("primary_proc_ind").alias("primary_procedure"),
                    "surg_proc_cd", "surgery").distinct()


@register("code_display", """
SELECT c.c_custkey AS person_id, c.c_nationkey AS race_cd, n.n_name AS race, r.r_name AS region
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def code_display(spark, sf_dir):
    """JN9: one lookup join per displayed code column."""
    r = roles(spark, sf_dir)
    p = r.person.select("person_id", "race_cd")
    p = attach_display(p, r.code_value, "race_cd", "race")
    nat = r.table("nation").select(F.col("n_nationkey").alias("race_cd"), F.col("n_regionkey").alias("region_cd"))
    p = p.join(nat, "race_cd", "left")
    p = attach_display(p, regions(r.table("region")), "region_cd", "region")
    return p.select("person_id", "race_cd", "race", "region")

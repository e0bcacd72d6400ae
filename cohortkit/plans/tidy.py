"""Tidy layer (PL10-PL18, PL20): exports -> analysis tables, as Spark plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import safe_number, strip_prefix
from ..operators.flags import (any_of, attach_flags, condition_flags, full_join_chain, pattern_flags,
                               prefix_conditions, value_flags)
from ..operators.frames import key_first, stack_by_name
from ..operators.lookup import literal_table
from ..operators.picks import first_by, first_value_many
from ..session import scratch_path
from ..sources import exports as X
from ..sources.sinks import batch_ids, read_bundle, write_bundle, write_table
from ..sources.tables import canonicalise, load, read_positional, read_topic, schema_of
from .registry import ORACLES, QUERIES, register

# Fixed values of the fixture study.
MEASURE_EVENTS = {"weight": "purchase", "height": "view", "bmi": "click"}
HISTORY_PATTERNS = {"a_fib": "purch", "cva": "sign", "pe": "err|vie", "dvt": "cli"}
CONDITIONS = [("HTN", "Brand#1"), ("DM", "Brand#2"), ("DMcx", "Brand#3")]
HOME_MEDS = ["purchase", "view", "click"]
DISCHARGE_MEDS = ["purchase", "view", "click", "signup", "error", "refund"]      # the last is in no data
EXCLUDED_ALLERGY = "err"
ID_PREFIX = "^Customer#"
BATCH_SIZE = 40


def _t(spark, sf_dir, name):
    return load(spark, sf_dir, name)


def _person_demog(spark, sf_dir):
    return X.person_demographics(_t(spark, sf_dir, "customer"), _t(spark, sf_dir, "nation"))


def _enc_demog(spark, sf_dir):
    return X.encounter_demographics(_t(spark, sf_dir, "orders"))


@register("patient_table", """
WITH f AS (SELECT user_id AS id, event_type AS ev, value AS v,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts NULLS LAST, event_id) AS rn
           FROM events WHERE event_type = 'click' OR (event_type IN ('purchase', 'view') AND event_id % 5 <> 0))
SELECT c.c_name AS fin, CAST(20 + c.c_custkey % 70 AS DOUBLE) AS age, c.c_mktsegment AS gender, n.n_name AS race,
       w.v AS weight, h.v AS height, b.v AS bmi
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN f w ON w.id = c.c_custkey AND w.ev = 'purchase' AND w.rn = 1
LEFT JOIN f h ON h.id = c.c_custkey AND h.ev = 'view' AND h.rn = 1
LEFT JOIN f b ON b.id = c.c_custkey AND b.ev = 'click' AND b.rn = 1""")
def patient_table(spark, sf_dir):
    """PL10: demographics left-joined to three first measures (WIN1 x3, JN4),
    weight and height in the standard unit only.  The measure text is parsed
    with a safe cast (SC14); the three picks are one aggregate."""
    m = X.measures(_t(spark, sf_dir, "events")).withColumn("event_result", safe_number("event_result"))
    std = F.col("event_result_units") == "std"
    picks = first_value_many(m, "encounter_key", ["event_datetime", "event_id"], {
        out: ("event_result", (F.col("event") == ev) if out == "bmi" else (F.col("event") == ev) & std)
        for out, ev in MEASURE_EVENTS.items()})
    out = _person_demog(spark, sf_dir).join(picks, "encounter_key", "left")
    return out.select("fin", "age", "gender", "race", "weight", "height", "bmi")


@register("allergy_list", """
SELECT DISTINCT c.c_name AS fin, lower(upper(e.event_type)) AS allergy
FROM events e JOIN customer c ON c.c_custkey = e.user_id
WHERE e.event_id % 7 <> 0 AND NOT regexp_matches(lower(upper(e.event_type)), 'err')""")
def allergy_list(spark, sf_dir):
    """PL11: rename report headers (PRJ3), lower case (SC12), drop missing,
    inactive and excluded entries (FLT10, FLT4), distinct, attach fin (JN5)."""
    raw = X.allergies_raw(_t(spark, sf_dir, "events"))
    a = raw.withColumnsRenamed({"Encounter Ref": "encounter_key", "Allergies": "allergy",
                                "Allergy Active Status": "allergy_status"})
    a = a.withColumn("allergy", F.lower("allergy"))
    a = a.filter(F.col("allergy").isNotNull() & (F.col("allergy_status") == "Active")
                 & ~F.col("allergy").rlike(EXCLUDED_ALLERGY))
    a = a.select("encounter_key", "allergy").distinct()
    return a.join(_person_demog(spark, sf_dir), "encounter_key").select("fin", "allergy")


@register("history_flags", """
WITH f AS (SELECT user_id, bool_or(regexp_matches(event_type, 'purch')) AS a_fib,
                  bool_or(regexp_matches(event_type, 'sign')) AS cva,
                  bool_or(regexp_matches(event_type, 'err|vie')) AS pe,
                  bool_or(regexp_matches(event_type, 'cli')) AS dvt
           FROM events WHERE regexp_matches(event_type, 'purch|sign|err|vie|cli') GROUP BY user_id)
SELECT c.c_name AS fin, coalesce(f.a_fib, false) AS a_fib, coalesce(f.cva, false) AS cva,
       coalesce(f.pe, false) AS pe, coalesce(f.dvt, false) AS dvt
FROM customer c FULL JOIN f ON f.user_id = c.c_custkey""")
def history_flags(spark, sf_dir):
    """PL12: code-pattern flags (AGG3) in one groupBy, joined to every id
    (JN6, full outer like the tidy chain) and filled with FALSE (PRJ6)."""
    codes = _t(spark, sf_dir, "events").select(F.col("user_id").alias("encounter_key"),
                                              F.col("event_type").alias("diag_code"))
    flags = pattern_flags(codes, "encounter_key", "diag_code", HISTORY_PATTERNS)
    base = _person_demog(spark, sf_dir).select("encounter_key", "fin")
    return attach_flags(base, flags, "encounter_key", how="full").select("fin", *HISTORY_PATTERNS)


@register("comorbidity_flags", """
WITH cond(condition, prefix) AS (VALUES ('HTN', 'Brand#1'), ('DM', 'Brand#2'), ('DMcx', 'Brand#3')),
d AS (SELECT l.l_orderkey AS id, p.p_brand AS code FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
      WHERE l.l_linestatus = 'F'),
f AS (SELECT d.id, bool_or(c.condition = 'HTN') AS htn, bool_or(c.condition = 'DM') AS dm,
             bool_or(c.condition = 'DMcx') AS dmcx
      FROM d JOIN cond c ON starts_with(d.code, c.prefix) GROUP BY d.id)
SELECT lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS fin, coalesce(f.htn, false) AS htn,
       coalesce(f.dm OR f.dmcx, false) AS diabetes
FROM orders o FULL JOIN f ON f.id = o.o_orderkey""")
def comorbidity_flags(spark, sf_dir):
    """AGG4 + SC16: codes -> condition groups by prefix (broadcast condition
    table, equi join on generated prefixes), one flag per condition,
    diabetes = DM OR DMcx, every encounter kept."""
    cond = literal_table(spark, CONDITIONS, "condition string, prefix string")
    # codes -> conditions on the code dimension (one row per code), then the
    # diagnosis facts join only the codes that have a condition
    part = _t(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("diag_code"))
    coded_parts = prefix_conditions(part, "diag_code", cond) \
        .select(F.col("p_partkey").alias("l_partkey"), "condition")
    diag = X.diagnosis_keys(_t(spark, sf_dir, "lineitem")).filter(F.col("diag_type") == "FINAL")
    coded = diag.join(coded_parts, "l_partkey")
    flags = condition_flags(coded, "encounter_key", "condition", [c for c, _ in CONDITIONS])
    flags = flags.select("encounter_key", F.col("HTN").alias("htn"), any_of(["DM", "DMcx"]).alias("diabetes"))
    base = _enc_demog(spark, sf_dir)
    return attach_flags(base, flags, "encounter_key", how="full").select("fin", "htn", "diabetes")


# Fixed values of the fixture study: code patterns of the one history table.
HISTORY_CODES = {"a_fib": "1$", "cva": "2$", "pe": "#[34]", "dvt": "5$"}


@register("history_table", """
WITH d AS (SELECT l.l_orderkey AS id, p.p_brand AS code FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
           WHERE l.l_linestatus = 'F'),
f AS (SELECT id, bool_or(starts_with(code, 'Brand#1')) AS htn,
             bool_or(starts_with(code, 'Brand#2') OR starts_with(code, 'Brand#3')) AS diabetes,
             bool_or(regexp_matches(code, '1$')) AS a_fib, bool_or(regexp_matches(code, '2$')) AS cva,
             bool_or(regexp_matches(code, '#[34]')) AS pe, bool_or(regexp_matches(code, '5$')) AS dvt
      FROM d GROUP BY id)
SELECT lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS fin, coalesce(htn, false) AS htn,
       coalesce(diabetes, false) AS diabetes, coalesce(a_fib, false) AS a_fib, coalesce(cva, false) AS cva,
       coalesce(pe, false) AS pe, coalesce(dvt, false) AS dvt
FROM orders o LEFT JOIN f ON f.id = o.o_orderkey""")
def history_table(spark, sf_dir):
    """PL12 on one id: hypertension, diabetes and four code flags, joined by a
    chain of full outer joins (JN6) on the encounter and filled with FALSE."""
    cond = literal_table(spark, CONDITIONS, "condition string, prefix string")
    part = _t(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("diag_code"))
    coded_parts = prefix_conditions(part, "diag_code", cond) \
        .select(F.col("p_partkey").alias("l_partkey"), "condition")
    diag = X.diagnosis_keys(_t(spark, sf_dir, "lineitem")).filter(F.col("diag_type") == "FINAL")
    groups = condition_flags(diag.join(coded_parts, "l_partkey"), "encounter_key", "condition", [c for c, _ in CONDITIONS])
    groups = groups.select("encounter_key", F.col("HTN").alias("htn"), any_of(["DM", "DMcx"]).alias("diabetes"))
    codes = diag.join(part.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey")
    flags = pattern_flags(codes, "encounter_key", "diag_code", HISTORY_CODES)
    chain = full_join_chain([_enc_demog(spark, sf_dir), groups, flags], "encounter_key")
    return chain.filter(F.col("fin").isNotNull()).select("fin", "htn", "diabetes", *HISTORY_CODES)


@register("primary_code", """
SELECT lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS fin, p.p_brand AS diag_code, p.p_name AS diag_description
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_linestatus = 'F' AND l.l_linenumber = 1""")
def primary_code(spark, sf_dir):
    """PL13: final primary diagnoses (FLT1), fin attached (JN5), key first (PRJ4)."""
    diag = X.diagnoses(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part")).filter(F.col("diag_type") == "FINAL")
    p = diag.filter(F.col("diag_seq") == "Primary").select("encounter_key", "diag_code", "diag_description")
    p = p.join(_enc_demog(spark, sf_dir), "encounter_key")
    return key_first(p, "fin", drop=["encounter_key"])


@register("procedure_list", """
SELECT lpad(CAST(o.o_orderkey AS VARCHAR), 10, '0') AS fin, p.p_brand AS proc_code,
       p.p_name AS proc_description, l.l_shipdate AS proc_date
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE regexp_matches(p.p_brand, '1')""")
def procedure_list(spark, sf_dir):
    """PL14: procedures whose code contains a pattern anywhere (FLT3), fin first."""
    pr = X.procedures(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part")).filter(F.col("proc_code").rlike("1"))
    pr = pr.join(_enc_demog(spark, sf_dir), "encounter_key")
    return key_first(pr, "fin", drop=["encounter_key"])


@register("plan_list", """
SELECT c.c_name AS fin, e.props AS plan_name, e.event_type AS plan_type, e.value AS plan_class
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) e
JOIN customer c ON c.c_custkey = e.user_id WHERE e.rn = 1""")
def plan_list(spark, sf_dir):
    """PL15: first plan row per (id, plan type) in file order (WIN2), fin attached."""
    raw = X.insurance_raw(_t(spark, sf_dir, "events")).withColumnsRenamed({
        "Encounter ID": "encounter_key", "Primary Health Plan Name": "plan_name",
        "Primary Health Plan Type": "plan_type", "Primary Health Plan Fin Class": "plan_class"})
    first = first_by(raw, ["encounter_key", "plan_type"], ["input_order"])
    return first.join(_person_demog(spark, sf_dir), "encounter_key").select("fin", "plan_name", "plan_type", "plan_class")


def _med_flags_sql(names, parity):
    cols = ", ".join(f"bool_or(event_type = '{n}') AS {n}" for n in names)
    outs = ", ".join(f"coalesce(f.{n}, false) AS {n}" for n in names)
    inlist = ", ".join(f"'{n}'" for n in names)
    return f"""
WITH f AS (SELECT user_id, {cols} FROM events
           WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = {parity} AND event_type IN ({inlist})
           GROUP BY user_id)
SELECT c.c_name AS fin, {outs} FROM customer c FULL JOIN f ON f.user_id = c.c_custkey"""


def _med_flags(spark, sf_dir, med_type, names):
    o = X.outpatient(_t(spark, sf_dir, "events")).filter(F.col("med_type") == med_type)
    flags = value_flags(o, "encounter_key", "med", names)
    base = _person_demog(spark, sf_dir).select("encounter_key", "fin")
    return attach_flags(base, flags, "encounter_key", how="full").select("fin", *names)


@register("med_flags_home", _med_flags_sql(HOME_MEDS, 0))
def med_flags_home(spark, sf_dir):
    """PL16: home drug list pivoted to one flag per requested drug (AGG5)."""
    return _med_flags(spark, sf_dir, X.HOME, HOME_MEDS)


@register("med_flags_discharge", _med_flags_sql(DISCHARGE_MEDS, 1))
def med_flags_discharge(spark, sf_dir):
    """PL17: discharge drug flags; drugs absent from the data still get a
    column, all FALSE."""
    return _med_flags(spark, sf_dir, X.DISCHARGE, DISCHARGE_MEDS)


@register("id_batches", """
WITH ids AS (SELECT DISTINCT regexp_replace(c_name, '^Customer#', '') AS id FROM customer),
n AS (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM ids)
SELECT CAST((rn - 1) // 40 AS BIGINT) AS batch, string_agg(id, ';' ORDER BY id) AS ids,
       CAST(count(*) AS INTEGER) AS n_ids
FROM n GROUP BY 1""")
def id_batches(spark, sf_dir):
    """PL20: strip a leading pattern (SC13), then ids in delimited chunks of
    40 in id order (SNK4), numbered without a single-task window."""
    ids = _person_demog(spark, sf_dir).select(strip_prefix("fin", ID_PREFIX).alias("id"))
    return batch_ids(ids, "id", BATCH_SIZE)


@register("stack_groups", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, true AS is_case
FROM customer WHERE c_mktsegment = 'AUTOMOBILE'
UNION ALL
SELECT c_custkey, c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment, false AS is_case
FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' AND c_acctbal IS NOT NULL""")
def stack_groups(spark, sf_dir):
    """SET2 + PRJ2 + FLT10: two tagged sheets stacked by column name; the
    second lacks a column, which becomes NULL."""
    cust = _t(spark, sf_dir, "customer")
    cases = cust.filter(F.col("c_mktsegment") == "AUTOMOBILE").withColumn("is_case", F.lit(True))
    others = (cust.filter((F.col("c_mktsegment") != "AUTOMOBILE") & F.col("c_acctbal").isNotNull())
              .drop("c_acctbal").withColumn("is_case", F.lit(False)))
    return stack_by_name([cases, others])


POSITIONAL = [("person_id", "long"), ("fin", "string"), ("race_cd", "int"),
              ("balance", "double"), ("segment", "string")]


@register("positional_scan", """
SELECT c_custkey AS person_id, c_name AS fin, c_nationkey AS race_cd, c_acctbal AS balance,
       c_mktsegment AS segment FROM customer""")
def positional_scan(spark, sf_dir):
    """SRC3/SRC4: a sheet exported with its own header names is read back
    with names and types imposed by position.  The export goes to the
    cluster-shared scratch folder."""
    path = scratch_path(spark, "positional")
    write_table(_t(spark, sf_dir, "customer"), path, fmt="csv")
    return read_positional(spark, path, POSITIONAL)


# Fixed values of the fixture export: topic of each event type, report headers.
MEASURE_TYPES = ("view", "click", "purchase")
RAW_MEASURE_HEADERS = [("Event Id", "string"), ("Encounter ID", "string"),
                       ("Clinical Event", "string"), ("Clinical Event Result", "string")]


@register("topic_scan", """
SELECT event_id, user_id AS encounter_key, event_type AS event,
       TRY_CAST(CASE WHEN event_type IN ('view', 'click') THEN CAST(value AS VARCHAR) ELSE 'n/a' END AS DOUBLE)
         AS event_result
FROM events WHERE event_type IN ('view', 'click', 'purchase')""")
def topic_scan(spark, sf_dir):
    """SRC1 + SRC2: measures exported as a topic folder with report headers
    (results as text, some not numeric), found by the topic's name, and the
    raw headers mapped to canonical names with safe casts."""
    ev = _t(spark, sf_dir, "events")
    text = F.when(F.col("event_type").isin("view", "click"), F.col("value").cast("string")).otherwise(F.lit("n/a"))
    raw = ev.select(F.col("event_id").cast("string").alias("Event Id"),
                    F.col("user_id").cast("string").alias("Encounter ID"),
                    F.col("event_type").alias("Clinical Event"), text.alias("Clinical Event Result"))
    folder = scratch_path(spark, "exports")
    write_table(raw.filter(F.col("Clinical Event").isin(*MEASURE_TYPES)), f"{folder}/measures_2024", fmt="csv")
    got = read_topic(spark, folder, "measures", schema=schema_of(RAW_MEASURE_HEADERS))
    return canonicalise(got, {"event_id": ("Event Id", "long"), "encounter_key": ("Encounter ID", "long"),
                              "event": "Clinical Event", "event_result": ("Clinical Event Result", "double")})


# --- the deliverable (PL18) -------------------------------------------------------

BUNDLE = {"patients": "patient_table", "allergies": "allergy_list", "history": "history_table",
          "primary diagnosis": "primary_code", "procedures": "procedure_list", "insurance": "plan_list",
          "home meds": "med_flags_home", "discharge meds": "med_flags_discharge"}


@register("tidy_bundle", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows, {len(cols)} AS n_columns, '{codec}' AS codec FROM ({ORACLES[q]}) t"
    for name, q, cols, codec in [
        ("patients", "patient_table", range(7), "snappy"), ("allergies", "allergy_list", range(2), "snappy"),
        ("history", "history_table", range(7), "gz"), ("primary diagnosis", "primary_code", range(3), "snappy"),
        ("procedures", "procedure_list", range(4), "snappy"), ("insurance", "plan_list", range(4), "snappy"),
        ("home meds", "med_flags_home", range(4), "snappy"), ("discharge meds", "med_flags_discharge", range(7), "snappy")]))
def tidy_bundle(spark, sf_dir):
    """PL18 / SNK1-SNK3: the eight tidy tables written as one deliverable, one
    of them with another codec, and read back: rows, columns and codec."""
    folder = scratch_path(spark, "bundle")
    frames = {n: QUERIES[q](spark, sf_dir) for n, q in BUNDLE.items()}
    paths = write_bundle({n: f for n, f in frames.items() if n != "history"}, folder)
    paths |= write_bundle({"history": frames["history"]}, folder, compression="gzip")
    out = None
    for name, df in read_bundle(spark, paths).items():
        codec = F.regexp_extract(F.input_file_name(), r"\.(gz|snappy)\.parquet$", 1)
        row = df.select(codec.alias("codec")).agg(F.count(F.lit(1)).alias("n_rows"), F.max("codec").alias("codec")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"), "codec")
        out = row if out is None else out.unionByName(row)
    return out

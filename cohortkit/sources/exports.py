"""Tidy-layer inputs ("exports") derived from the fixture tables.

In the study these are files exported from the warehouse, one topic each,
with display texts already resolved and report-style header names.  Here
they are projections of the fixture tables with the same shape, so the
tidy operators run on Spark-derived data that grows with the tables.

Fixed values of the fixture mapping (the DuckDB oracles repeat them):
  person fin        = customer name
  encounter fin     = encounter id as text, left-padded with '0' to 10 chars
  diagnosis type    = 'FINAL' when line status is 'F', else 'WORKING'
  diagnosis seq     = 'Primary' for line 1, else 'Secondary'
  med type          = 'Recorded / Home Meds' when props.k is even,
                      else 'Prescription/Discharge Order'
  person age        = 20 + customer key % 70
  result unit       = 'alt' when event id % 5 = 0, else 'std'
  allergy status    = 'Inactive' when event id % 7 = 0, else 'Active'
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOME = "Recorded / Home Meds"
DISCHARGE = "Prescription/Discharge Order"


def person_demographics(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """demographics topic, person level: encounter_key, fin, age, gender, race."""
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("race"))
    return (customer.join(n, "c_nationkey", "left")
            .select(F.col("c_custkey").alias("encounter_key"), F.col("c_name").alias("fin"),
                    (F.col("c_custkey") % 70 + 20).cast("double").alias("age"),
                    F.col("c_mktsegment").alias("gender"), "race"))


def encounter_demographics(orders: DataFrame) -> DataFrame:
    """demographics topic, encounter level: encounter_key, fin."""
    return orders.select(F.col("o_orderkey").alias("encounter_key"),
                         F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("fin"))


def measures(events: DataFrame) -> DataFrame:
    """measures topic: the result is exported as text."""
    return events.select(F.col("user_id").alias("encounter_key"), F.col("event_type").alias("event"),
                         F.col("ts").alias("event_datetime"), F.col("value").cast("string").alias("event_result"),
                         F.when(F.col("event_id") % 5 == 0, "alt").otherwise("std").alias("event_result_units"),
                         F.col("event_id"))


def diagnosis_keys(lineitem: DataFrame) -> DataFrame:
    """diagnosis topic before the code text is attached: encounter_key,
    l_partkey (code id), diag_type, diag_seq."""
    return lineitem.select(
        F.col("l_orderkey").alias("encounter_key"), "l_partkey",
        F.when(F.col("l_linestatus") == "F", "FINAL").otherwise("WORKING").alias("diag_type"),
        F.when(F.col("l_linenumber") == 1, "Primary").otherwise("Secondary").alias("diag_seq"))


def diagnoses(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """diagnosis topic: encounter_key, diag_code, diag_type, diag_seq, diag_description."""
    p = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("diag_code"),
                    F.col("p_name").alias("diag_description"))
    return (diagnosis_keys(lineitem).join(p, "l_partkey")
            .select("encounter_key", "diag_code", "diag_type", "diag_seq", "diag_description"))


def procedures(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """procedures topic: encounter_key, proc_code, proc_description, proc_date."""
    p = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("proc_code"),
                    F.col("p_name").alias("proc_description"))
    return (lineitem.join(p, "l_partkey")
            .select(F.col("l_orderkey").alias("encounter_key"), "proc_code", "proc_description",
                    F.col("l_shipdate").alias("proc_date")))


def allergies_raw(events: DataFrame) -> DataFrame:
    """allergies topic with its report header names."""
    status = F.when(F.col("event_id") % 7 == 0, "Inactive").otherwise("Active")
    return events.select(F.col("user_id").alias("Encounter Ref"),
                         F.upper(F.col("event_type")).alias("Allergies"),
                         status.alias("Allergy Active Status"))


def outpatient(events: DataFrame) -> DataFrame:
    """outpatient meds topic: encounter_key, med, med_type."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    return events.select(F.col("user_id").alias("encounter_key"), F.col("event_type").alias("med"),
                         F.when(k % 2 == 0, HOME).otherwise(DISCHARGE).alias("med_type"))


def insurance_raw(events: DataFrame) -> DataFrame:
    """insurance topic with its report header names, plus the file order."""
    return events.select(F.col("user_id").alias("Encounter ID"),
                         F.col("props").alias("Primary Health Plan Name"),
                         F.col("event_type").alias("Primary Health Plan Type"),
                         F.col("value").alias("Primary Health Plan Fin Class"),
                         F.col("event_id").alias("input_order"))

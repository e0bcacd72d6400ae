"""Clinical role views over the driver's fixture tables.

The library's operators speak in clinical roles (encounter, person, code
dimension, procedure, clinical event, alias, code lookup).  A deployment maps
its own warehouse tables onto these roles once; this module is that mapping
for the fixture tables.  Every view is a plain projection (plus derived
columns), so Catalyst prunes unused columns and pushes filters through it to
the Parquet scan.

Fixed values of the fixture mapping (they define the synthetic data, and the
DuckDB oracles repeat them):
  discharge  = admit + (encounter id % 60) days, NULL when encounter id % 11 = 0
  birth      = 1930-01-01 + (person id * 17 % 20000) days
  valid_until = event time when event id % 7 = 0, else 2100-12-31
  alias      = type FIN: the encounter id, zero-padded to 10 (a second one, 'T' + id, when id % 13 = 0);
               type LISTING: the person id (a listed cohort names persons)
  event      = its person is the encounter's, but the next id on line 6; valid_until is the event time on
               line 7, else 2100-12-31; dose unit = return flag, rate unit = line status
  code text  = of a text code: the display of its first letter's number, A = 0
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load

OPEN_END = dt.datetime(2100, 12, 31)
BIRTH_EPOCH = dt.datetime(1930, 1, 1)


def _days(n):
    return F.make_dt_interval(days=n)


def encounters(orders: DataFrame) -> DataFrame:
    """ENCOUNTER: one row per encounter."""
    k = F.col("o_orderkey")
    disch = F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderdate") + _days((k % 60).cast("int")))
    return orders.select(
        k.alias("encntr_id"),
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderstatus").alias("encntr_type_class_cd"),
        F.col("o_orderpriority").alias("loc_facility_cd"),
        F.col("o_orderdate").alias("reg_dt_tm"),
        disch.cast("timestamp_ntz").alias("disch_dt_tm"),
    )


def persons(customer: DataFrame) -> DataFrame:
    """PERSON."""
    k = F.col("c_custkey")
    birth = F.lit(BIRTH_EPOCH).cast("timestamp_ntz") + _days((k * 17 % 20000).cast("int"))
    return customer.select(
        k.alias("person_id"),
        F.col("c_mktsegment").alias("sex_cd"),
        F.col("c_nationkey").alias("race_cd"),
        birth.cast("timestamp_ntz").alias("birth_dt_tm"),
    )


def nomenclature(part: DataFrame) -> DataFrame:
    """NOMENCLATURE: the code dimension."""
    return part.select(
        F.col("p_partkey").alias("nomenclature_id"),
        F.col("p_brand").alias("source_identifier"),
        F.col("p_type").alias("source_vocabulary"),
        F.col("p_name").alias("source_string"),
    )


def procedures(lineitem: DataFrame) -> DataFrame:
    """PROCEDURE (also DIAGNOSIS: same shape, priority = line number)."""
    return lineitem.select(
        F.col("l_orderkey").alias("encntr_id"),
        F.col("l_partkey").alias("nomenclature_id"),
        F.col("l_shipdate").alias("proc_dt_tm"),
        F.col("l_linenumber").alias("priority"),
        F.col("l_linestatus").alias("diag_type_cd"),
    )


def encounter_events(lineitem: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """CLINICAL_EVENT scoped to an encounter (measures, drugs given).  With
    ``orders`` the event's own person comes along (the composite key)."""
    line = F.col("l_linenumber")
    valid = F.when(line == 7, F.col("l_shipdate")).otherwise(F.lit(OPEN_END).cast("timestamp_ntz"))
    cols = [
        F.col("l_orderkey").alias("encntr_id"),
        F.col("l_returnflag").alias("event_cd"),
        F.col("l_linestatus").alias("result_units_cd"),
        F.col("l_quantity").alias("result_val"),
        F.col("l_shipdate").alias("event_end_dt_tm"),
        line.alias("line_cd"),
        F.col("l_partkey").alias("nomenclature_id"),
        F.col("l_discount").alias("infusion_rate"),
        (F.col("l_suppkey") % 25).alias("admin_route_cd"),
        F.col("l_tax").alias("tax"),
        valid.cast("timestamp_ntz").alias("valid_until_dt_tm"),
    ]
    if orders is None:
        return lineitem.select(*cols)
    o = orders.select("o_orderkey", "o_custkey")
    person = F.when(line == 6, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return lineitem.join(o, lineitem["l_orderkey"] == o["o_orderkey"]).select(*cols, person.alias("person_id"))


def person_events(events: DataFrame) -> DataFrame:
    """CLINICAL_EVENT scoped to a person, with a version end time."""
    valid = F.when(F.col("event_id") % 7 == 0, F.col("ts")).otherwise(F.lit(OPEN_END).cast("timestamp_ntz"))
    return events.select(
        F.col("event_id"),
        F.col("user_id").alias("person_id"),
        F.col("event_type").alias("event_cd"),
        F.col("value").alias("result_val"),
        F.col("ts").alias("event_end_dt_tm"),
        valid.cast("timestamp_ntz").alias("valid_until_dt_tm"),
        F.col("props"),
    )


FIN, LISTING = "FIN", "LISTING"      # alias types


def aliases(orders: DataFrame) -> DataFrame:
    """ENCNTR_ALIAS: outside identifiers of an encounter, by type.  One branch
    per type, so that a filter on the type drops the others."""
    k, key = F.col("o_orderkey"), F.col("o_orderkey").cast("string")

    def branch(kind, alias, rows=orders):
        return rows.select(k.alias("encntr_id"), F.lit(kind).alias("alias_type_cd"), alias.alias("alias"))

    return (branch(FIN, F.lpad(key, 10, "0"))
            .unionByName(branch(FIN, F.concat(F.lit("T"), key), orders.filter(k % 13 == 0)))
            .unionByName(branch(LISTING, F.col("o_custkey").cast("string"))))


def letter_code(col: str):
    """Numeric code of a coded text column: its first letter, A = 0."""
    return F.ascii(F.col(col)) - 65


def surgeries(lineitem: DataFrame) -> DataFrame:
    """SURGICAL_CASE joined to SURG_CASE_PROCEDURE: one row per case procedure;
    the stop time is start + line number hours."""
    start = F.col("l_shipdate")
    return lineitem.select(
        F.col("l_orderkey").alias("encntr_id"),
        start.alias("surg_start_dt_tm"),
        (start + F.make_dt_interval(hours=F.col("l_linenumber"))).cast("timestamp_ntz").alias("surg_stop_dt_tm"),
        F.col("l_linenumber").alias("primary_proc_ind"),
        F.col("l_partkey").alias("surg_proc_cd"),
    )


def regions(region: DataFrame) -> DataFrame:
    return region.select(F.col("r_regionkey").cast("long").alias("code"), F.col("r_name").alias("display"))


def code_values(nation: DataFrame) -> DataFrame:
    """Code -> display lookup."""
    return nation.select(F.col("n_nationkey").cast("long").alias("code"), F.col("n_name").alias("display"))


class Roles:
    """Lazy role views for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    @property
    def encounter(self) -> DataFrame:
        return encounters(self.table("orders"))

    @property
    def person(self) -> DataFrame:
        return persons(self.table("customer"))

    @property
    def nomenclature(self) -> DataFrame:
        return nomenclature(self.table("part"))

    @property
    def procedure(self) -> DataFrame:
        return procedures(self.table("lineitem"))

    @property
    def encounter_event(self) -> DataFrame:
        return encounter_events(self.table("lineitem"))

    @property
    def encounter_person_event(self) -> DataFrame:
        return encounter_events(self.table("lineitem"), self.table("orders"))

    @property
    def person_event(self) -> DataFrame:
        return person_events(self.table("events"))

    @property
    def alias(self) -> DataFrame:
        return aliases(self.table("orders"))

    @property
    def code_value(self) -> DataFrame:
        return code_values(self.table("nation"))

    @property
    def surgery(self) -> DataFrame:
        return surgeries(self.table("lineitem"))

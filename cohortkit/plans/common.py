"""Shared parameters of the registered queries (fixture run of the study).

Fixed values of the fixture study (the DuckDB oracles repeat them):
  code pattern  ^Brand#[1-3]$   vocabulary PROMO
  window        1996-01-01 .. 1999-07-01 (closed), encounter class F
  listed ids    1, 2, 3, 5, 8, 13, 21, 34, 55, 89   group label CASE
  time zone     America/Chicago
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators.cohort import CohortSpec, build_cohort
from ..session import cut_lineage
from ..sources.roles import LISTING, Roles

TZ = "America/Chicago"
LISTED_IDS = (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)

SPEC = CohortSpec(
    code_pattern="^Brand#[1-3]$",
    vocabulary="PROMO",
    window=(dt.datetime(1996, 1, 1), dt.datetime(1999, 7, 1)),
    tz=None,
    encounter_filters={"encntr_type_class_cd": "F"},
    ids=LISTED_IDS,
    group="CASE",
    alias_type=LISTING,
)


def roles(spark: SparkSession, sf_dir: str) -> Roles:
    return Roles(spark, sf_dir)


def cohort(spark: SparkSession, sf_dir: str, spec: CohortSpec = SPEC,
           materialize: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(procedure cohort, listed cohort, union).  ``materialize`` writes the
    union once to the shared checkpoint folder: a query that uses the cohort
    in differently-pruned places would otherwise compute it (a full scan of
    the procedure facts) more than once."""
    r = roles(spark, sf_dir)
    pts, listed, allp = build_cohort(r.encounter, r.procedure, r.nomenclature, r.alias, spec)
    if materialize:
        allp = cut_lineage(allp)
    return pts, listed, allp


# SQL prefix shared by the DuckDB oracles: the same role views and cohort.
ORACLE_ROLES = """
enc AS (
  SELECT o_orderkey AS encntr_id, o_custkey AS person_id, o_orderstatus AS encntr_type_class_cd,
         o_orderpriority AS loc_facility_cd, o_orderdate AS reg_dt_tm,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL
              ELSE o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) END AS disch_dt_tm
  FROM orders),
per AS (
  SELECT c_custkey AS person_id, c_mktsegment AS sex_cd, c_nationkey AS race_cd,
         TIMESTAMP '1930-01-01' + to_days(CAST(c_custkey * 17 % 20000 AS INTEGER)) AS birth_dt_tm
  FROM customer),
pev AS (
  SELECT event_id, user_id AS person_id, event_type AS event_cd, value AS result_val,
         ts AS event_end_dt_tm,
         CASE WHEN event_id % 7 = 0 THEN ts ELSE TIMESTAMP '2100-12-31' END AS valid_until_dt_tm,
         props
  FROM events)"""

FIN_SQL = """,
fin AS (
  SELECT encntr_id, lpad(CAST(encntr_id AS VARCHAR), 10, '0') AS fin FROM enc
  UNION ALL SELECT encntr_id, 'T' || CAST(encntr_id AS VARCHAR) FROM enc WHERE encntr_id % 13 = 0),
cv AS (SELECT n_nationkey AS code, n_name AS display FROM nation)"""

# in the oracle's own form: existence tests on the role views
ORACLE_COHORT = ORACLE_ROLES + FIN_SQL + """,
icd AS (SELECT p_partkey AS nomenclature_id FROM part
        WHERE regexp_matches(p_brand, '^Brand#[1-3]$') AND p_type = 'PROMO'),
pts AS (SELECT encntr_id, person_id, reg_dt_tm FROM enc
        WHERE reg_dt_tm >= TIMESTAMP '1996-01-01' AND reg_dt_tm <= TIMESTAMP '1999-07-01'
          AND encntr_type_class_cd = 'F'
          AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = encntr_id
                      AND l_partkey IN (SELECT nomenclature_id FROM icd))),
listed AS (SELECT encntr_id, person_id, reg_dt_tm, 'CASE' AS pt_group FROM enc
           WHERE person_id IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)),
allp AS (SELECT encntr_id, person_id, reg_dt_tm FROM enc
         WHERE encntr_id IN (SELECT encntr_id FROM pts) OR encntr_id IN (SELECT encntr_id FROM listed))"""


def with_cohort(body: str) -> str:
    return "WITH " + ORACLE_COHORT + "\n" + body


def with_roles(body: str) -> str:
    return "WITH " + ORACLE_ROLES + "\n" + body

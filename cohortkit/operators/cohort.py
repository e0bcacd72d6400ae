"""Cohort selection (PL1 building blocks: JN2, JN11, SET1, JN3, PRM1-PRM3).

* ``code_set``      -- code dimension reduced to the ids of matching codes.
* ``by_procedure``  -- encounters in a time window that have a procedure with
  a code in the set.  Written as left-semi joins: an existence test never
  multiplies rows, needs no DISTINCT afterwards, and the procedure side is
  only scanned for its two key columns.
* ``by_ids``        -- encounters named by an outside id list (the "prompt"),
  tagged with a group label.
* ``union_cohorts`` -- de-duplicating union: one DISTINCT after the UNION.
* ``tag_groups``    -- every cohort row with the label of the listed group
  (NULL for encounters found only by procedure).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeops import local_to_utc
from .predicates import between, matches

COHORT_COLS = ("encntr_id", "person_id", "reg_dt_tm")


@dataclass(frozen=True)
class CohortSpec:
    """Parameters of one extraction run (PRM1-PRM4)."""

    code_pattern: str
    vocabulary: str | None = None
    window: tuple | None = None          # (start, end) in local wall time
    tz: str | None = None                # zone of the window bounds
    encounter_filters: dict = field(default_factory=dict)  # column -> required value
    ids: Sequence | DataFrame | None = None   # listed cohort (alias values)
    group: str = "CASE"
    alias_type: str | None = None        # type of the listed aliases


def code_set(nomenclature: DataFrame, pattern: str, vocabulary: str | None = None,
             code_col: str = "source_identifier", vocab_col: str = "source_vocabulary",
             id_col: str = "nomenclature_id") -> DataFrame:
    """Ids of codes matching an anchored pattern (FLT1, FLT2, AGG1)."""
    cond = matches(code_col, pattern)
    if vocabulary is not None:
        cond = cond & (F.col(vocab_col) == F.lit(vocabulary))
    return nomenclature.filter(cond).select(id_col).distinct()


def in_window(encounters: DataFrame, window, tz: str | None, col: str = "reg_dt_tm") -> DataFrame:
    """Closed window on admission time; the bounds are shifted to UTC as
    literals so the comparison is pushed to the scan (FLT6, SC1)."""
    if window is None:
        return encounters
    lo, hi = window
    return encounters.filter(between(col, local_to_utc(lo, tz), local_to_utc(hi, tz)))


def by_procedure(encounters: DataFrame, procedures: DataFrame, codes: DataFrame,
                 window=None, tz: str | None = None, filters: dict | None = None,
                 cols: Sequence[str] = COHORT_COLS) -> DataFrame:
    """Encounters in ``window`` with at least one procedure coded in ``codes``
    (JN2).  Existence is a left-semi join, not join + DISTINCT."""
    enc = in_window(encounters, window, tz)
    for c, v in (filters or {}).items():
        enc = enc.filter(F.col(c) == F.lit(v))
    # no hint: the planner broadcasts the code set when its size is under the threshold
    coded = procedures.select("encntr_id", "nomenclature_id").join(
        codes.select("nomenclature_id"), "nomenclature_id", "left_semi")
    # de-duplicate before the shuffle: the partial (map-side) distinct folds an
    # encounter with a third of all procedure rows to one row per map task
    return enc.join(coded.select("encntr_id").distinct(), "encntr_id", "left_semi").select(*cols)


def listed_encounters(aliases: DataFrame, ids, alias_type: str | None = None) -> DataFrame:
    """Encounter ids whose alias (of ``alias_type``) is in ``ids`` (PRM1, JN11).

    A short Python list is an ``isin`` filter; a DataFrame of ids is a
    left-semi join (broadcast by the planner when small)."""
    if alias_type is not None:
        aliases = aliases.filter(F.col("alias_type_cd") == F.lit(alias_type))
    if isinstance(ids, DataFrame):
        key = ids.columns[0]
        sel = aliases.join(ids.select(F.col(key).cast("string").alias("alias")).distinct(), "alias", "left_semi")
    else:
        sel = aliases.filter(F.col("alias").isin([str(i) for i in ids]))
    return sel.select("encntr_id").distinct()


def by_ids(encounters: DataFrame, aliases: DataFrame, ids, group: str | None = "CASE",
           cols: Sequence[str] = COHORT_COLS, alias_type: str | None = None) -> DataFrame:
    """Listed cohort (JN11): outside ids -> encounters, tagged (PRJ2)."""
    enc = encounters.join(listed_encounters(aliases, ids, alias_type), "encntr_id", "left_semi").select(*cols)
    if group is not None:
        enc = enc.withColumn("pt_group", F.lit(group))
    return enc


def union_cohorts(*frames: DataFrame, cols: Sequence[str] = COHORT_COLS) -> DataFrame:
    """De-duplicating UNION of cohorts (SET1): one DISTINCT after the union,
    not one per branch."""
    out = frames[0].select(*cols)
    for f in frames[1:]:
        out = out.unionByName(f.select(*cols))
    return out.distinct()


def tag_groups(cohort: DataFrame, listed: DataFrame, encounters: DataFrame | None = None,
               extra_cols: Sequence[str] = ()) -> DataFrame:
    """Cohort rows with the listed group's label (JN3, left outer).

    ``encounters`` adds further encounter columns (class, discharge)."""
    tags = listed.select("encntr_id", "pt_group").distinct()
    out = cohort.join(tags, "encntr_id", "left")
    if encounters is not None and extra_cols:
        out = out.join(encounters.select("encntr_id", *extra_cols), "encntr_id", "inner")
    return out


def build_cohort(enc: DataFrame, proc: DataFrame, nomen: DataFrame, alias: DataFrame,
                 spec: CohortSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(procedure cohort, listed cohort, union) for one spec."""
    codes = code_set(nomen, spec.code_pattern, spec.vocabulary)
    pts = by_procedure(enc, proc, codes, spec.window, spec.tz, spec.encounter_filters)
    listed = by_ids(enc, alias, spec.ids, spec.group, alias_type=spec.alias_type)
    allp = union_cohorts(listed, pts)
    return pts, listed, allp

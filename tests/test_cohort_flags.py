import datetime as dt

from pyspark.sql import functions as F

import pytest

from cohortkit.operators.cohort import by_ids, by_procedure, code_set, tag_groups, union_cohorts
from cohortkit.operators.flags import (attach_flags, full_join_chain, pattern_flags, prefix_conditions,
                                       value_flags)
from cohortkit.operators.lookup import literal_table
from cohortkit.operators.predicates import any_of, current_rows, literal_prefix, matches

D = dt.datetime(2017, 3, 1)


def test_literal_prefix():
    assert literal_prefix("^027[0-3]") == "027"
    assert literal_prefix("^Brand#[1-3]$") == "Brand#"
    assert literal_prefix("^ab?c") == "a"
    assert literal_prefix("027") == ""
    assert literal_prefix("^a|b") == ""


def test_code_anchor(spark):
    df = spark.createDataFrame([("0271X",), ("B0271",), ("0274",)], "code string")
    anchored = [r.code for r in df.filter(matches("code", "^027[0-3]")).collect()]
    loose = [r.code for r in df.filter(F.col("code").rlike("027")).collect()]
    assert anchored == ["0271X"] and len(loose) == 3


def test_both_cohorts(spark):
    enc = spark.createDataFrame([(1, 10, D), (2, 20, D), (3, 30, D)], "encntr_id long, person_id long, reg_dt_tm timestamp_ntz")
    proc = spark.createDataFrame([(1, 100), (2, 100), (2, 100)], "encntr_id long, nomenclature_id long")
    nomen = spark.createDataFrame([(100, "0271", "ICD")], "nomenclature_id long, source_identifier string, source_vocabulary string")
    alias = spark.createDataFrame([(2, 20), (3, 30)], "encntr_id long, alias long")
    pts = by_procedure(enc, proc, code_set(nomen, "^027[0-3]", "ICD"), (D, D))
    listed = by_ids(enc, alias, [20, 30])
    allp = union_cohorts(listed, pts)
    tagged = {r.encntr_id: r.pt_group for r in tag_groups(allp, listed).collect()}
    assert tagged == {1: None, 2: "CASE", 3: "CASE"}
    # union is idempotent
    assert union_cohorts(allp, allp).count() == allp.count() == 3
    # a DataFrame id list gives the same cohort as a Python list
    ids = spark.createDataFrame([(20,), (30,), (30,)], "x long")
    assert sorted(by_ids(enc, alias, ids).collect()) == sorted(listed.collect())


def test_stale_version_and_dose_or_event(spark):
    df = spark.createDataFrame([(1, dt.datetime(2050, 1, 1)), (2, dt.datetime(2100, 12, 31))],
                               "id int, valid_until_dt_tm timestamp_ntz")
    assert [r.id for r in current_rows(df).collect()] == [2]
    rows = [(i, dose, ev) for i, (dose, ev) in enumerate(
        [(d, e) for d in (None, 0.0, 5.0) for e in ("IN", "OUT", None)])]
    m = spark.createDataFrame(rows, "id int, dose double, ev string")
    kept = {r.id for r in m.filter(any_of([F.col("dose") > 0, F.col("ev").isin("IN")])).collect()}
    assert kept == {i for i, d, e in rows if (d or 0) > 0 or e == "IN"}


def test_flags_one_shuffle_equals_full_join_chain(spark):
    codes = spark.createDataFrame([(1, "I48.1"), (1, "I63"), (2, "I2782"), (2, "I82"), (4, "X")],
                                  "id long, code string")
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, fin string")
    pats = {"af": "I48", "cva": "I63", "pe": "I26|I2782", "dvt": "I82"}
    one = attach_flags(base, pattern_flags(codes, "id", "code", pats), "id", how="full")
    parts = [base] + [codes.filter(F.col("code").rlike(p)).select("id").distinct().withColumn(f, F.lit(True))
                      for f, p in pats.items()]
    chain = full_join_chain(parts, "id")
    cols = ["id", "fin", *pats]
    assert sorted(one.select(*cols).collect()) == sorted(chain.select(*cols).collect())
    got = {r.id: r for r in one.collect()}
    assert not any([got[3].af, got[3].cva, got[3].pe, got[3].dvt])      # id without codes: all FALSE
    assert 4 not in got                          # codes matching no pattern add no id (as in the chain)


def test_absent_drug_and_pivot_sums(spark):
    meds = spark.createDataFrame([(1, "asa"), (1, "asa"), (1, "clop"), (2, "clop")], "id long, med string")
    names = ["asa", "clop", "warfarin"]
    f = value_flags(meds, "id", "med", names)
    assert f.columns == ["id", *names]
    rows = f.collect()
    assert all(r.warfarin is False for r in rows)
    assert sum(int(r[n]) for r in rows for n in names) == meds.distinct().count()


def test_prefix_conditions_equal_startswith(spark):
    codes = spark.createDataFrame([(1, "E119"), (2, "E1165"), (3, "I10"), (4, "E1"), (5, "Z00")],
                                  "id long, code string")
    cond = literal_table(spark, [("DM", "E119"), ("DMcx", "E116"), ("HTN", "I10"), ("ANY_E", "E1")],
                         "condition string, prefix string")
    got = sorted((r.id, r.condition) for r in prefix_conditions(codes, "code", cond, [2, 3, 4]).collect())
    want = sorted((i, c) for i, code in codes.collect() for c, p in cond.collect() if code.startswith(p))
    assert got == want


def test_prefix_conditions_of_any_length(spark):
    words = ["I21", "I21.4", "I2", "E11.9", "E1", "", None, "I21", "X"]
    codes = spark.createDataFrame(list(enumerate(words)), "id long, code string")
    table = [("heart", "I2"), ("attack", "I21"), ("attack", "I21.4"), ("sugar", "E11"), ("exact", "E11.9"), ("any", ""), ("none", None)]
    cond = spark.createDataFrame(table, "condition string, prefix string")
    got = sorted((r.id, r.condition) for r in prefix_conditions(codes, "code", cond).collect())
    assert got == sorted((i, c) for i, w in enumerate(words) for c, p in table
                         if w is not None and p is not None and w.startswith(p))


def test_prefix_conditions_of_a_length_not_named(spark):
    codes = spark.createDataFrame([(1, "E119"), (2, "I10")], "id long, code string")
    cond = literal_table(spark, [("DM", "E119"), ("HTN", "I10")], "condition string, prefix string")
    with pytest.raises(Exception, match="length"):
        prefix_conditions(codes, "code", cond, [3]).collect()


def test_in_codes_list_and_table_agree(spark):
    from cohortkit.operators.predicates import complete, in_codes
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, "a", 4.0)],
                               "id int, code string, v double")
    codes = spark.createDataFrame([("a",), ("c",), ("c",)], "code string")
    by_list = sorted(r.id for r in in_codes(df, "code", ["a", "c"]).collect())
    by_table = sorted(r.id for r in in_codes(df, "code", codes).collect())
    assert by_list == by_table == [1, 3, 4]
    assert sorted(r.id for r in complete(df, ["code", "v"]).collect()) == [1, 3, 4]


def test_shuffle_width_helper():
    from cohortkit.session import shuffle_partitions_for
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 << 40) == 409600        # 100 TB / 256 MB

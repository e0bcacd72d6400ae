"""Plan-shape checks: the properties the scale design relies on."""
import pytest

from cohortkit.plans.registry import load_all

SF = "/root/testdata/sf0.001"
QUERIES, _ = load_all()


@pytest.fixture(autouse=True)
def full_metadata(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    yield
    spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_or_row_udfs(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_cohort_filters_reach_the_scan(spark):
    plan = _plan(QUERIES["cohort_by_procedure"](spark, SF))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    orders = next(s for s in scans if "o_orderdate" in s)
    part = next(s for s in scans if "p_brand" in s)
    lineitem = next(s for s in scans if "l_partkey" in s)
    assert "GreaterThanOrEqual(o_orderdate" in orders and "LessThanOrEqual(o_orderdate" in orders
    assert "EqualTo(o_orderstatus,F)" in orders
    assert "StringStartsWith(p_brand,Brand#)" in part and "EqualTo(p_type,PROMO)" in part
    # only the two key columns of the big fact table are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in lineitem


def test_local_midnight_bound_is_pushed(spark):
    plan = _plan(QUERIES["tz_bounds"](spark, SF))
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T06:00)" in scan


@pytest.mark.parametrize("name", ["cohort_by_procedure", "cohort_by_ids", "cohort_union", "cohort_group_tag",
                                  "diagnosis_list", "tz_local_day", "tz_local_day_fixed", "tz_local_day_listed",
                                  "meds_given", "vitals_around_procedure", "events_around_anchor", "surgery_list",
                                  "code_display", "patient_table", "history_table", "comorbidity_flags"])
def test_no_job_runs_while_a_plan_is_built(spark, name):
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, name)
    try:
        QUERIES[name](spark, SF)
        tracker = spark.sparkContext.statusTracker()
        stages = [k for j in tracker.getJobIdsForGroup(group) for k in tracker.getJobInfo(j).stageIds]
        # reading a table's footer for its schema is the only job allowed
        assert all(tracker.getStageInfo(k).name.startswith("parquet at") for k in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_listed_cohort_does_not_read_the_code_dimension(spark):
    assert "p_brand" not in _plan(QUERIES["cohort_by_ids"](spark, SF))


def test_backward_search_keeps_some_terms_and_drops_others(spark):
    from cohortkit.plans.regression import MODEL_TERMS, subset_search
    lf = subset_search(spark, "/root/testdata/sf0.01")
    assert {"express", "tenure", "rush"} <= set(lf.terms) and len(MODEL_TERMS) - len(lf.terms) >= 4


def test_dummy_columns_of_a_further_segment(spark, tmp_out):
    c = spark.createDataFrame([(1, "AUTOMOBILE"), (2, "BUILDING"), (3, "MARINE"), (4, None)],
                              "c_custkey long, c_mktsegment string")
    c.write.parquet(f"{tmp_out}/customer.parquet")
    out = QUERIES["dummy_columns"](spark, tmp_out)
    assert out.columns == ["c_custkey", "c_mktsegment_BUILDING", "c_mktsegment_MARINE"]
    assert sorted(map(tuple, out.collect())) == [(1, 0, 0), (2, 1, 0), (3, 0, 1), (4, None, None)]

"""Every registered query against its DuckDB oracle (the driver's gate),
at sf0.001 for speed; queries without an oracle must run and return rows."""
import pytest

from cohortkit.plans.registry import load_all
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    rows, problems = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() >= 1


def test_entry(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

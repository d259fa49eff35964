"""Every registered query against its SQL on the given tables."""

import __spark_entry__ as contract
import pytest

from oracle import connect, differences

QUERIES, CHECKS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:2] == ["l_suppkey", "l_returnflag"]
    assert df.count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    result = df.toArrow()
    if name in CHECKS:
        # A filter may select nothing from the smallest tables; SQL says so too.
        assert differences(result, duck.sql(CHECKS[name]).to_arrow_table()) == []
    else:
        assert result.num_rows > 0

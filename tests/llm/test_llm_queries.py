"""The registered corpus queries against their SQL on the given tables."""

import pytest

from canton.llm.queries import CHECKS, QUERIES
from oracle import connect, differences


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, sf_dir, name):
    result = QUERIES[name](spark, sf_dir).toArrow()
    assert differences(result, connect(sf_dir).sql(CHECKS[name]).to_arrow_table()) == []

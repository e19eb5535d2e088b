import pytest

import oracle
from tablemargin.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    difference = oracle.compare(QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), ORACLES[name])
    assert difference is None, difference

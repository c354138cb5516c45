"""The queries that SQL can express against DuckDB on the smallest test tables."""

import pytest

from pagesmith.llm.oracle import ORACLE
from pagesmith.llm.queries import QUERIES
from tests import oracle_check as O

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return O.duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    ok, msg, _, _ = O.compare(spark, con, key, QUERIES[key], ORACLE[key], SF)
    assert ok, msg

"""Registered queries of the subpackage against their SQL."""

import pytest
from compare import compare, connect

from hourlens.llm.registry import CHECKS, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), CHECKS[name]) == []

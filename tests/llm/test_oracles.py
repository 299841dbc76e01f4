"""Registered queries of the text operators against their SQL counterparts, types included."""

import pytest
from compare import assert_same
from llm_data import SF

from orderpulse.llm import queries


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_its_sql(spark, name):
    assert assert_same(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF)

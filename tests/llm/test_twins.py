"""Queries that SQL can express return the rows of their DuckDB twins."""

import pytest
from twins import differences

from pricewave.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_twin(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), queries.ORACLES[name], SF) == []

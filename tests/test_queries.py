"""Each registered query returns the rows of its DuckDB twin."""

import pytest
from twins import differences

from pricewave.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_twin(spark, name):
    assert differences(registry.QUERIES[name](spark, SF), registry.ORACLES[name], SF) == []


def test_entry_has_all():
    import __spark_entry__ as entry

    known = entry.queries()
    assert set(registry.QUERIES) <= set(known) and set(entry.oracle_sql()) <= set(known)

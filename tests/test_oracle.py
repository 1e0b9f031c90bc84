"""Every query with SQL against that SQL; every other one runs and gives rows."""

import pytest

from reelspan.plans import registry
from tests.oracle import by_spark, by_sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, name):
    names, mine = by_spark(registry.QUERIES[name](spark, SF))
    theirs_names, theirs = by_sql(registry.SQL[name], SF)
    assert names == theirs_names
    assert len(mine) == len(theirs)
    assert [(a, b) for a, b in zip(mine, theirs) if a != b][:3] == []


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0

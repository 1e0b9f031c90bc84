"""Queries with SQL against that SQL, and what every query returns."""

import pytest

from reelspan.llm import queries
from tests.oracle import by_spark, by_sql

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    names, mine = by_spark(queries.QUERIES[name](spark, SF))
    theirs_names, theirs = by_sql(queries.SQL[name], SF)
    assert (names, len(mine)) == (theirs_names, len(theirs))
    assert [(a, b) for a, b in zip(mine, theirs) if a != b][:3] == []

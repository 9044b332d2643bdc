"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

from layerlake.catalogue import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, small, con, name):
    """Same columns and rows, from a plan without pairwise joins and without Python."""
    got, want, plan = oracle.differences(QUERIES[name], spark, small, con)
    assert got[0] == want[0]
    assert got[1] == want[1]
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert word not in plan


def test_entry_points(spark):
    import __spark_entry__ as driver

    extra = set(driver.queries()) - set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())
    assert all(name == "pipeline" or name.startswith("op") for name in extra)
    first = driver.entry(spark)
    assert first.columns == driver.entry(spark).columns
    assert first.count() > 0

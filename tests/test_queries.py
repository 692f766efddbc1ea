"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ours = QUERIES[name](spark, SF).toPandas()
    if name in ORACLES:
        assert difference(ours, con.execute(ORACLES[name]).df()) is None
    else:
        assert len(ours) > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["word", "weight"] and rows.count() > 0

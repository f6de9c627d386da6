"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entries
from tests.compare import difference

QUERIES, ORACLES = entries.queries(), entries.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(name, spark, con, folder):
    assert difference(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    rows = entries.entry(spark).collect()
    assert len(rows) == 10
    assert sum(row["flow_count"] for row in rows) == 1000
    counts = [row["flow_count"] for row in rows]
    assert counts == sorted(counts, reverse=True)

"""Every query with a SQL counterpart must return exactly its rows, names and types."""

import oracle
import pytest

import __spark_entry__ as entry_point

ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, folder, name):
    assert oracle.difference(entry_point.queries()[name](spark, folder), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_point.queries())


def test_entry_returns_a_full_list(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 25
    assert [r.prediction for r in rows] == sorted((r.prediction for r in rows), reverse=True)

"""Every query that has SQL must give the same rows as DuckDB running that SQL."""

import pytest
from compare import differences, duck

from tallyhawk.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)

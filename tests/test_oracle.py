"""Every query with reference SQL, beside DuckDB on the smallest tables."""

import pytest

from metricloom.catalog.oracle import SQL
from metricloom.catalog.queries import QUERIES
from oracle_check import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_reference_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert differences(spark, duck, name, QUERIES[name], SQL[name], FOLDER) is None

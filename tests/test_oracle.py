"""Every registered query against its SQL at the smallest scale factor."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, duck

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, connection, name):
    ok, message = compare(spark, connection, SF, name, queries()[name], SQL.get(name))
    assert ok, message


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names():
    assert set(SQL) <= set(queries())

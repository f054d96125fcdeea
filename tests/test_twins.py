"""Every query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from spindrift.catalog import QUERIES, SQL
from twins import difference, open_tables

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(TABLES)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_twin(spark, tables, name):
    assert difference(queries()[name](spark, TABLES), tables, oracle_sql()[name]) is None

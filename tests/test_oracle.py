"""Every registered query against its DuckDB definition on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from assayweave.plans import catalog, oracles
from tests.oracle import connection, difference

SF_DIR = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()
QUERIES = catalog.REGISTRY
# Queries without an SQL form.
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_every_query_has_a_definition():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY and not set(SQL) - set(QUERIES)


def test_entry_module_registers_them():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in ROWS_ONLY:
        assert df.count() > 0
    else:
        assert difference(df, con, SQL[name]) is None


def test_entry(spark):
    assert entry(spark).columns[0] == "target_key"

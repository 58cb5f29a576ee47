"""Every registered query that SQL can express, against DuckDB, value by value."""

import pytest

from compare import difference, oracle_connection
from lectern.plans import catalog, oracle

QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_its_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(name, spark, sf_dir, con):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) is None


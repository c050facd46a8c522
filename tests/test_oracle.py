"""Every registered query against its DuckDB counterpart."""

import pytest

import __spark_entry__ as contract
from oracle.duckdb_sql import ORACLE
from tests.compare import differences, open_duckdb
from tests.conftest import SF_DIR

QUERIES = {name: query for name, query in contract.queries().items() if name in ORACLE}
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    with open_duckdb(SF_DIR) as con:
        yield con


def test_every_query_has_sql():
    own = {name for name in contract.queries() if name != "pipeline" and not name.startswith("op")}
    assert own == set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() == 7

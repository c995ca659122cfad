import pytest
from check_oracles import compare, duckdb_on

import __spark_entry__ as contract
from tellerlake.plans import catalog


@pytest.fixture(scope="module")
def connection(request):
    from conftest import SF_DIR

    return duckdb_on(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(contract.queries()) & set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, connection, sf_dir, name):
    same, note = compare(spark, connection, sf_dir, name)
    assert same, note


def test_entry(spark):
    assert contract.entry(spark).count() > 0

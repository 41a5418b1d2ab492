"""Every named query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from vitalgrid.plans import catalog, oracle as catalog_oracle
from tools.check_oracle import difference, oracle_connection


@pytest.fixture(scope="module")
def oracle(smoke_dir):
    return oracle_connection(smoke_dir)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) & set(catalog_oracle.queries())))
def test_query_equals_sql(spark, oracle, smoke_dir, name):
    assert difference(spark, oracle, name, smoke_dir) is None


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog_oracle.queries())


def test_oracle_sql_leaves_the_catalogue_alone():
    before = catalog_oracle.queries()
    assert entry.oracle_sql() == entry.oracle_sql()
    assert catalog_oracle.queries() == before
    assert set(before) == set(catalog.QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r["node_name"]: r["total_records"] for r in rows} == {"hospital_A": 256, "hospital_B": 261, "hospital_C": 278}

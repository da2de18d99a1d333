"""Every query of the catalog against its SQL, over the whole smallest tables."""

import pytest

import __spark_entry__ as entry
from oreflow.plans.catalog import catalog
from oreflow.plans.oracle import oracle
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog(), oracle()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem, n = difference(spark, con, QUERIES[name], SQL[name], SF)
    assert problem is None
    assert n > 0


def test_the_entry_point_offers_every_query():
    assert QUERIES.keys() <= entry.queries().keys() and SQL.items() <= entry.oracle_sql().items()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


def test_entry_is_lazy_and_has_rows(spark):
    df = entry.entry(spark)
    assert "order_id" in df.columns
    assert not df.isEmpty()

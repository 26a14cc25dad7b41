import pytest
from tests.oracle import agree

from tallyloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql(spark, name):
    agree(spark, catalog.QUERIES[name], catalog.ORACLES[name], "/root/testdata/sf0.001")


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)

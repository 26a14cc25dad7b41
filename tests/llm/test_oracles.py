import pytest
from tests.oracle import agree

from tallyloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    agree(spark, queries.QUERIES[name], queries.ORACLES[name], "/root/testdata/sf0.001")

import pytest
from __spark_entry__ import oracle_sql, queries
from compare import differences, oracle, unwanted_in_plan

from weekloom.plans.catalog import QUERIES
from weekloom.plans.catalog_sql import SQL


@pytest.fixture(scope="module")
def connection(small):
    return oracle(small)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, small, connection, name):
    result = QUERIES[name](spark, small)
    assert unwanted_in_plan(result) == []
    assert differences(result, connection, SQL[name]) == []

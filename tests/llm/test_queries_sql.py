"""Queries of the dealt operators next to their SQL, on whole tables."""

import pytest
from compare import differences, oracle

from weekloom.llm.queries import QUERIES
from weekloom.llm.queries_sql import SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), oracle(FOLDER), SQL[name]) == []

"""Queries with SQL against DuckDB on the same tables."""

import pytest
from oracle import connect, differences

from textflow.llm.oracle import SQL
from textflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) == []

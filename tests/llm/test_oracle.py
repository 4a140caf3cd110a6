"""The queries with SQL against DuckDB, as the driver compares them."""

import pytest

from reelstack.llm.oracle import ORACLE_SQL
from reelstack.llm.queries import QUERIES
from tests.conftest import SF001
from tests.oracle_compare import compare, duck_connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    res = compare(spark, duck_connection(SF001), name, SF001, QUERIES[name], ORACLE_SQL[name])
    assert res["status"] == "match", res

"""Every query of the subpackage that has SQL, against DuckDB over the same tables."""

import pytest

from millrace.llm import queries
from oracle import assert_same, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert_same(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name])

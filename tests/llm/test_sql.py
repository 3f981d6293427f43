"""The queries of the subpackage that have SQL against DuckDB on the smallest tables."""

import pytest

from quarrystone.llm import queries
from tests.compare import DATA, connect, rows_of


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_as_sql(spark, name):
    ours, theirs = queries.QUERIES[name](spark, DATA).toPandas(), connect().execute(queries.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)

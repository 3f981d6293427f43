"""Every query with SQL against DuckDB on the smallest tables."""

import pytest

from quarrystone.plans import registry
from tests.compare import DATA, connect, rows_of

SQL = registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    ours, theirs = registry.queries()[name](spark, DATA).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows_of(ours) == rows_of(theirs)


def test_partitions_change_nothing(spark):
    one = {}
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        for q in ("noise_floor", "exact_count_split", "hash_split"):
            got = rows_of(registry.queries()[q](spark, DATA).toPandas())
            assert one.setdefault(q, got) == got
    spark.conf.set("spark.sql.shuffle.partitions", "4")

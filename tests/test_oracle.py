import pytest
from compare import duckdb_result, spark_result

import __spark_entry__ as entry
from tidemark.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, folder, name):
    found = spark_result(entry.queries()[name](spark, folder))
    expected = duckdb_result(entry.oracle_sql()[name], folder)
    assert found == expected
    assert sum(found[1].values()) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["order_id", "customer_id"] and df.count() > 0

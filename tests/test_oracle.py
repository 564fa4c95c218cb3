"""Every registered query gives the rows of its SQL statement."""

import pytest
from compare import oracle_connection, oracle_rows, spark_rows

import __spark_entry__ as entry
from kedai import catalog
from oracle import statements

QUERIES = catalog.queries()
STATEMENTS = statements()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = oracle_connection(sf_dir)
    yield connection
    connection.close()


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(name, spark, sf_dir, oracle):
    columns, rows = spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = oracle_rows(oracle, STATEMENTS[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() == 1217
    assert df.columns[:2] == ["date_key", "msic_group_key"]

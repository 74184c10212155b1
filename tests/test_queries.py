"""Every named query against its SQL on the given tables."""

import importlib

import compare
import pytest

from crmflow.plans.catalog import QUERIES

ENTRY = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    columns, rows = compare.spark_rows(ENTRY.queries()[name](spark, sf_dir))
    sql_columns, sql_rows = compare.sql_rows(con, ENTRY.oracle_sql()[name])
    assert columns == sql_columns
    assert rows == sql_rows
    assert rows


def test_entry_is_the_history(spark):
    df = ENTRY.entry(spark)
    assert {"id", "valid_from", "valid_to", "is_current"} <= set(df.columns)
    assert df.count() > 0

"""Every registered query against its SQL, over whole tables."""

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from tools.check_oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name)) is None


def test_entry_gives_one_metric_row(spark):
    row = entry.entry(spark).collect()
    assert len(row) == 1 and row[0].error is None and row[0].business_data_date == "2001-08-01"


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

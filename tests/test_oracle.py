"""Every registered query equals its SQL counterpart on the generated tables."""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, SF_DIR, name, db) is None


def test_queries_without_sql_return_rows(spark):
    for name in entry.queries().keys() - entry.oracle_sql().keys():
        assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["fact_sales", "star_join", "kpi_filtered", "top_customers", "dim_product"]
)
def test_without_broadcasts(spark, db, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare(spark, SF_DIR, name, db) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

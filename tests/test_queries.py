"""Every registered query against its SQL statement, on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from oracles import statements
from tallyloom import catalog
from tests.check_sql import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, STATEMENTS = contract.queries(), statements()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(catalog.all_queries()) == set(STATEMENTS)
    assert set(contract.oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, STATEMENTS[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "segment", "industry", "customer_count", "total_mrr", "avg_health", "avg_percentile", "top_10_customers", "segment_benchmark_mrr",
    ]

"""All registered queries beside their SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from queries.registry import QUERIES
from verify import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    ok, text = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), FOLDER)
    assert ok, text


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())

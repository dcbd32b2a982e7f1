"""The registered queries against their SQL equivalents on the smallest test data."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from anaquel.catalog.oracles import oracles
from anaquel.catalog.queries import registered
from tools.compare import compare, sql_session

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return sql_session(FOLDER)


def test_every_query_has_an_equivalent():
    assert registered().keys() == oracles().keys()
    assert registered().keys() <= entry.queries().keys() and oracles().keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", list(registered()))
def test_query(spark, connection, name):
    equal, detail = compare(spark, connection, FOLDER, name)
    assert equal, detail


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "usuario"

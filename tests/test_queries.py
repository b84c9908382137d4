"""Every query against its SQL on the smallest driver tables."""

from pathlib import Path

import pytest
from oracle import connect, difference

from printfold.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not here")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, FOLDER), db, SQL[name]) is None


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert QUERIES.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()

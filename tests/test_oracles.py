"""Every query that can be stated as SQL gives the same rows in both engines."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verification.check import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, connection, name):
    rows = queries()[name](spark, SMALL).toPandas()
    assert compare(rows, connection.execute(oracle_sql()[name]).df()) == "ok"


def test_entry_returns_rows(spark):
    assert entry(spark).count() == 5

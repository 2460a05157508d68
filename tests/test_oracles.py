"""Every query of the warehouse against its SQL, over whole tables."""

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as entry
from tidemart.checks import oracles, registry

SF_DIR = "/root/testdata/sf0.01"
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(registry.queries()) <= set(entry.queries())
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, con, name):
    assert spark_rows(entry.queries()[name](spark, SF_DIR)) == duck_rows(con, ORACLES[name])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "id" and df.count() > 0

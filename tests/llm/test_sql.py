"""Corpus queries against their SQL, and all of them over a whole small folder."""

import pytest
from compare import connect, duck_rows, spark_rows

from tidemart.llm import queries

SF_DIR = "/root/testdata/sf0.01"
ORACLES = queries.oracle_sql()


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert spark_rows(queries.queries()[name](spark, SF_DIR)) == duck_rows(connect(SF_DIR), ORACLES[name])


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in ORACLES])
def test_query_runs_alike_twice(spark, name):
    first = spark_rows(queries.queries()[name](spark, "/root/testdata/sf0.001"))
    assert first == spark_rows(queries.queries()[name](spark, "/root/testdata/sf0.001"))


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{i}" for i in range(1, 14)]

"""Every named query at the smallest scale: against DuckDB where it has SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, duck_rows, spark_rows, type_gaps

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    frame = queries()[name](spark, SF_DIR)
    got = spark_rows(frame)
    sql = oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    assert not type_gaps(frame, duck, sql)
    assert got == duck_rows(duck, sql)


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 8

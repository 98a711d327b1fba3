"""Every registered query against its SQL at the smallest scale."""

import oracle
import pytest

from __spark_entry__ import entry, oracle_sql, queries

PATH = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(PATH)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    query = queries()[name]
    if name in SQL:
        assert oracle.compare(spark, con, name, query, SQL[name], PATH) == ""
    else:
        rows = query(spark, PATH)
        assert len(rows.collect()) > 0 and rows.columns


def test_entry(spark):
    assert entry(spark).count() > 0

"""Every registered query against its SQL, on the smallest bundled tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as registered
from filetide.catalog import queries as catalog

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered.queries(), registered.oracle_sql()
OWN = sorted(catalog.queries())


@pytest.fixture(scope="module")
def database():
    return connect(SF)


def test_every_query_has_sql():
    assert OWN == sorted(set(SQL) & set(OWN)) and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, database, name):
    assert differences(QUERIES[name](spark, SF), database, SQL[name]) == []


def test_entry(spark):
    out = registered.entry(spark)
    assert out.columns == ["vo", "bytes_read", "bytes_written", "events", "unique_files"]
    assert out.count() > 0

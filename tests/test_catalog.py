"""Every query with an SQL twin, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from ledgermill.plans import catalog, catalog_runs, catalog_streams  # noqa: F401

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return round(float(value), 6)
    return str(value).replace(" 00:00:00", "")


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, duck, name):
    found = catalog.QUERIES[name](spark, DATA)
    wanted = duck.sql(catalog.ORACLES[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found.columns, [tuple(x) for x in found.collect()]) == rows(wanted.columns, wanted.fetchall())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES.keys() - catalog.ORACLES.keys()))
def test_query_without_sql(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

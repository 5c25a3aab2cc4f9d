"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as registry
from workload import catalog
from workload.check import connect, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


def test_every_query_has_an_oracle():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == set()
    assert set(QUERIES) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() > 0

"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from pagefold.plans import suite

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the tables are elsewhere")


def plain(v):
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v if not isinstance(v, float) or math.isnan(v) else round(v, 9)


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"create view {f.split('.')[0]} as select * from '{DIR}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(suite.queries()))
def test_query(spark, tables, name):
    df = suite.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in suite.oracle_sql():
        assert got
        return
    cursor = tables.execute(suite.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

"""Every registered query against its SQL twin on the smallest tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from terraloom.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


def _norm(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, decimal.Decimal):
        return repr(float(x))
    if isinstance(x, datetime.datetime) and x.time() == datetime.time(0):
        return str(x.date())
    return str(x)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(_norm, r)) for r in df.select(*cols).collect())
    assert name in SQL
    rel = con.execute(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted(tuple(_norm(r[i]) for i in at) for r in rel.fetchall())
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from sievemill.plans import registry


def _plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else v


def compare(spark, data, name, query, sql):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    df = query(spark, data)
    cols = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = sorted((tuple(_plain(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    assert sorted(names) == cols
    assert got == want, name


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, data, name):
    compare(spark, data, name, registry.QUERIES[name], registry.ORACLES[name])

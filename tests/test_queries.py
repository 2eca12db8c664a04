"""Every registered query of the engine against its SQL on the smallest tables."""

import duckdb
import pytest
from weftline import plans

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    if hasattr(v, "as_tuple"):
        v = float(v)
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(plans.queries()))
def test_query(spark, duck, name):
    df = plans.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = plans.oracle_sql().get(name)
    if sql is None:
        return
    r = duck.sql(sql)
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    assert got == sorted((tuple(plain(x[i]) for i in at) for x in r.fetchall()), key=repr)

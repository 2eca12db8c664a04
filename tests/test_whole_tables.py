"""Queries over all rows of their tables, against plain SQL over the files."""

import duckdb
import pytest
from weftline import plans

DIR = "/root/testdata/sf0.001"
KINDS = "KEYWORD,IDENTIFIER,OPERATOR,NUMBER,KEYWORD,IDENTIFIER,KEYWORD,IDENTIFIER,OPERATOR,STRING"
WHOLE = {
    "tokens": f"SELECT o_orderkey, 10 AS n, '{KINDS}' AS kinds FROM '{DIR}/orders.parquet'",
    "star_except": f"SELECT o_orderkey, o_custkey, o_orderstatus FROM '{DIR}/orders.parquet'",
    "unpivot_amounts": f"SELECT l_orderkey, l_linenumber, unnest(['l_tax', 'l_discount']) AS metric, unnest([l_tax, l_discount]) AS v FROM '{DIR}/lineitem.parquet'",
    "unpivot_multi": f"SELECT l_orderkey, l_linenumber, unnest(['price', 'qty']) AS k, unnest([l_extendedprice, l_quantity]) AS a, unnest([l_discount, l_tax]) AS b FROM '{DIR}/lineitem.parquet'",
}


@pytest.mark.parametrize("name", list(WHOLE))
def test_all_rows(spark, name):
    r = duckdb.sql(WHOLE[name])
    got = plans.queries()[name](spark, DIR).select(*r.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(r.fetchall(), key=repr)

"""The registered queries against their SQL on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as entry  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def normal(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    return f"{float(x):.6g}" if isinstance(x, float) or type(x).__name__ == "Decimal" else str(x)


#: A fifth of the queries, to keep the tests short; the driver compares all of them.
SOME = sorted(entry.oracle_sql())[::5]


@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    want = con.sql(entry.oracle_sql()[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = sorted(tuple(normal(r[c]) for c in names) for r in got.collect())
    index = [want.columns.index(c) for c in names]
    assert rows == sorted(tuple(normal(r[i]) for i in index) for r in want.fetchall())


def test_names_and_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0

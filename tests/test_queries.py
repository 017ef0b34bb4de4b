"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pytest

from episodica import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, duck, name):
    df = plans.queries()[name](spark, SF)
    rows, cols = df.collect(), sorted(df.columns)
    sql = plans.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want = duck.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    key = lambda x: tuple(map(repr, x))
    assert sorted([tuple(plain(r[c]) for c in cols) for r in rows], key=key) == sorted([tuple(plain(r[i]) for i in at) for r in want.fetchall()], key=key)

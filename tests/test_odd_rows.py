"""Queries against their SQL on rows that the given tables have few of."""

import datetime

import duckdb

from episodica import plans


def both(spark, folder, name):
    """A query's rows and its SQL's, sorted, over the tables of a folder."""
    con = duckdb.connect()
    for path in folder.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}/*.parquet'")
    want = con.execute(plans.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = [tuple(r[c] for c in names) for r in plans.queries()[name](spark, str(folder)).collect()]
    return sorted(map(repr, got)), sorted(map(repr, want.fetchall()))


def test_decimate_keeps_zeros_as_values(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [(100 * u + i, start + datetime.timedelta(seconds=i), u, "click", 0.0 if i in zeros else 1.0 + i * 7 % 50, '{"k": 1}') for u, zeros in enumerate([(13,), (3, 4, 40), range(50), ()]) for i in range(50)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got, want = both(spark, tmp_path, "decimate")
    assert got == want and len(got) > 40


def test_reasons_of_halves(spark, tmp_path):
    # the video scores of the first three orders lie next to a half of the last digit shown
    orders = [(368255, 153, 4), (483301, 138, 5), (223746, 171, 6), *((e, 3 * e + 1, 1 + e % 7) for e in range(1, 60))]
    rows = [(e, float(q - n + 1 if i == 0 else 1)) for e, q, n in orders for i in range(n)]
    spark.createDataFrame(rows, "l_orderkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("decision_reasons", "decision_reasons_all"):
        got, want = both(spark, tmp_path, name)
        assert got == want

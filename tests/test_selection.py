"""Percentiles by sketches and counts against Spark's own and numpy's."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators import selection
from episodica.operators.selection import percentiles

QS = (0.0, 0.013, 0.05, 0.5, 0.8, 0.95, 0.99, 1.0)


def _rows(spark, columns):
    return spark.createDataFrame(list(zip(*columns)), ", ".join(f"c{i} double" for i in range(len(columns)))).repartition(7)


def _want(values, q):
    known = sorted(v for v in values if v is not None and not math.isnan(v))
    return float(np.percentile(known, 100 * q)) if known else None


@pytest.mark.parametrize("k,most,margin", [(8192, 1 << 20, 0.005), (64, 1 << 20, 0.05), (64, 100, 0.05), (64, 100, 0.0), (8, 1, 0.0001)])
def test_as_plain_percentiles(spark, k, most, margin):
    draw = random.Random(k + most)
    n = 5000
    columns = [
        [draw.gauss(0, 1) for _ in range(n)],
        [math.exp(draw.gauss(0, 8)) * draw.choice((-1, 1)) for _ in range(n)],
        [7.5 if draw.random() < 0.4 else draw.random() * 10 for _ in range(n)],
        [draw.choice((None, float("nan"), 3.0, 4.0, -0.0, 0.0)) for _ in range(n)],
        [3.25] * n,
        [None] * n,
        [float(i) if i < 3 else None for i in range(n)],
        [1e300 * draw.choice((1, -1)) for _ in range(n)],
    ]
    got, r = percentiles(_rows(spark, columns), {f"x{i}": (F.col(f"c{i}"), QS) for i in range(len(columns))}, k=k, most=most, margin=margin, total=F.sum("c4"))
    assert r.total == 3.25 * n
    for i, values in enumerate(columns):
        assert r[f"n_x{i}"] == sum(v is not None and not math.isnan(v) for v in values)
        for q, v in zip(QS, got[f"x{i}"]):
            w = _want(values, q)
            assert (v is None and w is None) or math.isclose(v, w, rel_tol=1e-12, abs_tol=1e-12), (i, q, v, w)


def test_equals_sparks_own(spark):
    d = spark.range(30000).select((F.rand(5) * 100).alias("v"))
    own = d.agg(F.percentile("v", F.array(*[F.lit(q) for q in QS]))).first()[0]
    got, _ = percentiles(d, {"v": (F.col("v"), QS)}, k=256, most=200)
    assert got["v"] == own


def test_empty_and_clashing(spark):
    d = spark.createDataFrame([], "v double, __v0 string")
    assert percentiles(d, {"v": (F.col("v"), (0.5,))})[0] == {"v": [None]}
    one = spark.createDataFrame([(2,)], "v int")
    assert percentiles(one, {"v": (F.col("v"), (0.0, 0.3))})[0] == {"v": [2.0, 2.0]}


def test_a_sketch_holds_as_many_values_as_its_size(spark):
    for n, k, parts in ((1, 64, 1), (2, 64, 5), (63, 64, 3), (64, 64, 1), (64, 64, 13), (64, 64, 64), (4096, 4096, 29), (selection.K, selection.K, 7)):
        d = spark.range(0, n, 1, parts).select(((F.col("id") * 7919) % n).cast("double").alias("v"))
        s = d.agg(F.kll_sketch_agg_double("v", F.lit(k)))
        (got,) = selection._brackets(d, [s.first()[0]], [[(n, i, i) for i in range(n)]] if n < 100 else [[(n, i, i) for i in range(0, n, n // 50)]], 0.01)
        assert [x[0] for x in got] == [float(i) for i in (range(n) if n < 100 else range(0, n, n // 50))]

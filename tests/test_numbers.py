"""Printed numbers against Python's own, for plain values, ties and carries."""

import random

import pytest

from pyspark.sql import functions as F

from episodica.functions.numbers import fixed, general


def values():
    rng = random.Random(11)
    out = [0.1525, 0.00012345, 9.99996e-05, 99999.6, 0.0005, 0.0015, 2.5, 0.125, 1e15 + 0.3, 123456789012.345, 1e22, 1.5e300, 4e-18, 0.0, 1.0, 999.9999999999999, 1000.0, 9999.5, 10000.5, 0.5, 1.5, 1e-5, 12345.0, 123455.0]
    out += [rng.uniform(0, 10 ** rng.randint(-6, 8)) for _ in range(20_000)]
    out += [round(rng.uniform(0, 1000), d) for d in (1, 2, 3, 4, 5) for _ in range(4_000)]
    out += [(2 * rng.randint(0, 10**5) + 1) / 2 / 10**d for d in (0, 1, 2, 3, 4) for _ in range(4_000)]
    return out + [-v for v in out[:2_000] if v]


@pytest.mark.parametrize("digits", [1, 2, 3, 4, 6])
def test_as_python_prints(spark, digits):
    df = spark.createDataFrame([(v,) for v in values()], "v double").repartition(4)
    got = df.select("v", fixed(F.col("v"), digits).alias("f"), general(F.col("v"), digits).alias("g")).collect()
    assert [(r.v, r.f) for r in got if r.f != f"{r.v:.{digits}f}" and abs(r.v) * 10**digits < 2**53] == []
    assert [(r.v, r.g) for r in got if r.g != f"{r.v:.{digits}g}" and (r.v == 0 or abs(r.v) > 1e-15) and abs(r.v) < 1e22] == []


def test_null(spark):
    row = spark.range(1).select(fixed(F.lit(None).cast("double"), 2).alias("f"), general(F.lit(None).cast("double"), 4).alias("g")).first()
    assert row.f is None and row.g is None

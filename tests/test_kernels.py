"""Kernels against plain numpy, and the identities that their definitions imply."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from episodica.functions import kernels as K
from episodica.operators import fit as T
from episodica.operators import measure as M
from episodica.operators import score as S


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_gradient_is_numpys(spark):
    r = np.random.default_rng(0)
    for n in (1, 2, 3, 4, 40):
        t, x = np.cumsum(r.uniform(0.01, 0.2, n)), r.normal(size=n)
        df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(t, x)], "e int, t double, x double")
        got = [v.g for v in df.select("t", K.gradient(F.col("x"), F.col("t"), W.partitionBy("e").orderBy("t")).alias("g")).orderBy("t").collect()]
        assert np.allclose(got, np.gradient(x, t) if n > 1 else [0.0])


def test_unmeasurable_values(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "v double")
    assert [r.v for r in df.select(K.clean(F.col("v")).alias("v")).collect()] == [1.0, None, None, None, None]
    assert value(spark, K.ramp(F.lit(None).cast("double"), 0, 1)) == 0.0
    assert value(spark, K.ramp(F.lit(0.5), 1, 1)) == 0.0
    assert value(spark, K.violation(F.lit(None).cast("double"))) is None
    assert value(spark, K.combine({"a": (F.lit(None).cast("double"), 1.0)})) is None


def test_stated_numbers(spark):
    assert value(spark, K.gauss(F.lit(2.0))) == pytest.approx(0.0773, abs=1e-4)
    assert value(spark, K.gauss(F.lit(-2.0))) == pytest.approx(0.3679, abs=1e-4)
    assert value(spark, K.decay(F.lit(0.5), 0.5)) == pytest.approx(math.exp(-1))
    parts = {"a": (F.lit(1.0), 0.3), "b": (F.lit(0.02), 0.4), "c": (F.lit(0.9), 0.3)}
    assert value(spark, K.combine(parts, "arithmetic")) == pytest.approx(0.578)
    assert value(spark, K.combine(parts)) == pytest.approx(math.exp(0.4 * math.log(0.02) + 0.3 * math.log(0.9)))
    for u, p in ((-1, 0), (0, 0), (0.5, 0.49), (1, 0.98), (2, 1 - 0.02**2), (80, 1.0)):
        assert value(spark, K.violation(F.lit(float(u)))) == pytest.approx(p)
    assert value(spark, K.cost(F.lit(60.0))) == pytest.approx(50 * -math.log(0.02))


def test_worse_is_never_better(spark):
    c = T.CRITERIA[12]
    rows = spark.range(0, 400).select((F.col("id") / 10).alias("v"))
    got = [r.c for r in rows.select("v", K.cost(K.position(F.col("v"), c.good, c.bad)).alias("c")).orderBy("v").collect()]
    assert all(b >= a for a, b in zip(got, got[1:]))


SCHEMA = "episode long, frame_index int, t double, state array<double>, action array<double>, eef array<double>, gravity array<double>, left_hand array<double>, right_hand array<double>"
GROUPS = {"right_arm": (0, 2), "waist": (2, 3)}


def episode(number, n, scale=1.0, dt=0.02, still=False, bare=False):
    rows = []
    for i in range(n):
        x = 0.0 if still else math.sin(i * 0.3) * scale
        eef = [x, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.5 + 2 * x, 0.3, 0.0, 0.0, 0.0, 0.0, 1.0]
        hand = [300.0 + (70 if i % 20 < 10 else -70)] * 6
        rows.append((number, i, i * dt, [x, x * 0.5, 1.0], None, *((None, None, None, None) if bare else (eef, [0.0, 0.1, -1.0], None, hand))))
    return rows


@pytest.fixture(scope="module")
def measured(spark):
    """Every case as an episode of one frame table, measured at once."""
    rows = [r for n in (1, 2, 3, 4) for r in episode(n, n)]
    rows += episode(10, 60) + episode(11, 60, 7.0) + episode(12, 60, 1.0, 0.1) + episode(20, 30, still=True) + episode(21, 30, bare=True)
    return {r.episode: r for r in M.measure(spark.createDataFrame(rows, SCHEMA), GROUPS).collect()}


def test_ldlj_ignores_amplitude_and_time_scale(measured):
    a, b, c = measured[10], measured[11], measured[12]
    assert a.ldlj_arm == pytest.approx(b.ldlj_arm) == pytest.approx(c.ldlj_arm)
    assert a.side == "right" and not a.degenerate and a.ldlj_body is None


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_short_episodes(measured, n):
    r = measured[n]
    assert r.n_frames == n and r.degenerate == (r.duration_s <= 0 or r.eef_path_m < 0.3) and (r.ldlj_arm is None or n >= 4)


def test_motionless_and_missing_channels(measured):
    still, bare = measured[20], measured[21]
    assert still.degenerate and still.acc_arm_rms is None and not still.valid
    assert bare.eef_path_m is None and bare.side == "right" and bare.grasp_transitions == -1 and bare.max_base_tilt_deg is None and not bare.degenerate


def test_hysteresis_counts_switches(measured):
    assert measured[10].grasp_transitions == 5


def test_documents_round_trip():
    p = T.Profile(task_duration_s=3.0)
    assert T.Profile.from_json(p.to_json()[:-1] + ', "later": 1}') == p
    c = T.Calibration(duration_median=1.0)
    assert T.Calibration.from_json(c.to_json()) == c


def test_decision_branches(spark):
    base = {f: False for f in M.HARD + M.SOFT} | {"episode": 1, "total": 0.9, "contact_rate_hz": 0.0, "semantic": 1.0, **{k: 0.9 for k in S.FAMILIES}}
    cases = [({}, "accept"), ({"degenerate": True}, "reject"), ({"semantic": 0.0}, "reject"), ({"total": 0.1}, "reject"), ({"video_frozen": True}, "review"), ({"contact_rate_hz": 0.6}, "review"), ({"semantic": 0.5}, "review"), ({"semantic": None}, "accept")]
    rows = [base | c | {"episode": i} for i, (c, _) in enumerate(cases)]
    schema = "episode long, total double, contact_rate_hz double, semantic double, " + ", ".join(f"{k} double" for k in S.FAMILIES) + ", " + ", ".join(f"{f} boolean" for f in M.HARD + M.SOFT)
    cols = [c.strip().split()[0] for c in schema.split(",")]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], schema)
    got = S.decide(df, S.Policy(mode="weighted")).orderBy("episode").collect()
    assert [r.decision for r in got] == [w for _, w in cases]
    assert got[3].reasons == ["score 0.100 < 0.35"] and got[1].reasons == ["flag:degenerate"] and got[0].reasons == []


def test_general_format(spark):
    for v, d in ((3.14159, 3), (1234567.0, 4), (0.00001234, 3), (0.0, 4), (-2.5, 4), (100.0, 4)):
        assert value(spark, S.general(F.lit(v), d)) == f"{v:.{d}g}"

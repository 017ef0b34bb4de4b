"""Whole-episode documents, picks, parsing and image faults against plain Python."""

import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica import plans
from episodica.functions import gray as G
from episodica.operators import detail as E
from episodica.operators import fit, inject, legacy
from episodica.operators import score as S

SF = "/root/testdata/sf0.001"


def test_registered_rows_say_something(spark):
    rows = {k: plans.queries()[k](spark, SF).collect() for k in ("vote_starts", "judge_replies", "eval_split", "orphans_of_orders", "unreadable", "legacy_degenerate", "image_blur")}
    assert all(rows.values())
    assert all(sum(r[c] for r in rows["vote_starts"]) > 0 for c in ("impact", "base", "tracking", "confirmed"))
    assert {bool(r.error) for r in rows["judge_replies"]} == {True, False} and len({r.note for r in rows["judge_replies"]}) > 6
    assert {r.degenerate for r in rows["legacy_degenerate"]} == {True, False}


def test_episode_detail_holds_every_episode(spark):
    rows = {r.episode: r for r in plans.queries()["episode_detail"](spark, SF).collect()}
    con = duckdb.connect()
    orders = [r[0] for r in con.execute(f"select distinct l_orderkey from '{SF}/lineitem.parquet'").fetchall()]
    assert sorted(rows) == sorted(orders)
    values = defaultdict(list)
    for u, v in con.execute(f"select user_id, value from '{SF}/events.parquet' order by ts, event_id").fetchall():
        values[u].append(v or None)
    both = set(rows) & set(values)
    assert both
    for e in both:
        (track,) = rows[e].tracks
        seen = [v for v in values[e] if v is not None]
        assert track.key == "value" and track.min == round(min(seen), 5) and track.max == round(max(seen), 5)
        assert track.y == [None if v is None else round(v, 5) for v in values[e]] and track.t == [round(0.02 * i, 4) for i in range(len(values[e]))]
        mask = [v is not None and v > 100 for v in values[e]]
        starts = sum(b and not a for a, b in zip([False, *mask], mask))
        assert len(rows[e].contact) == starts
    for e in set(rows) - set(values):
        assert rows[e].tracks == [] and rows[e].contact == [] and rows[e].idle == []
    one = rows[orders[0]]
    assert len(one.videos) == 1 and [m.place for m in one.measures] == sorted(m.place for m in one.measures)
    p = [c.p for c in one.criteria if c.p is not None]
    assert p == sorted(p, reverse=True)
    assert {r.discarded for r in rows.values()} == {True, False}


def test_measure_table_text(spark):
    d = spark.createDataFrame([(1, -17.256, 3, -1, "left", float("nan")), (2, None, 0, 4, None, 0.5)], "episode int, ldlj_wrist double, contact_count int, grasp_transitions int, side string, idle_fraction double")
    got = defaultdict(dict)
    for r in E.measure_table(d).collect():
        got[r.episode][r.name] = r.value
    assert got[1] == {"LDLJ wrist": "-17.26", "events": "3", "grasp transitions": "-", "working side": "left", "idle fraction": "-"}
    assert got[2] == {"LDLJ wrist": "-", "events": "0", "grasp transitions": "4", "working side": "-", "idle fraction": "0.500"}


def test_measure_table_of_several_columns(spark):
    d = spark.createDataFrame([(1, 3, 0, None, 90, 100), (2, 1, 2, 3, None, None)], "episode int, impact_count int, base_disturbance_count int, tracking_divergence_count int, video_frames_decoded int, video_frames_declared int")
    got = {(r.episode, r.name): r.value for r in E.measure_table(d).collect()}
    assert got == {(1, "impact / base / tracking"): "3 / 0 / -", (1, "frames decoded"): "90 / 100", (2, "impact / base / tracking"): "1 / 2 / 3", (2, "frames decoded"): "- / -"}
    assert E.measure_table(d.drop("base_disturbance_count", "video_frames_declared").withColumn("side", F.lit("left"))).count() == 2


def test_no_good_episode(spark):
    rows = spark.createDataFrame([(1, 0.7), (1, 0.2), (2, 0.1)], "episode int, total double")
    assert legacy.good_episodes(rows).collect() == [] and [r.episode for r in legacy.good_episodes(rows, require="any", some=True).collect()] == [1]
    with pytest.raises(ValueError):
        legacy.good_episodes(rows, some=True)


def test_score_rows_order(spark):
    d = spark.createDataFrame([(1, 0.5, 0.7, "review", ["a", "b"], 0.1, True, 0.5)], "episode int, total double, severity double, decision string, reasons array<string>, timing double, degenerate boolean, semantic double")
    got = E.score_rows(d)
    assert got.columns == ["episode", "total", "severity", "decision", "timing", "degenerate", "semantic", "reasons"] and got.first().reasons == "a; b"


def test_pick(spark):
    rows = spark.createDataFrame([(e, c, e % 2) for e in range(40) for c in ("a", "b")], "episode int, camera string, quantile int")
    low = E.pick(rows, 1, 3)
    assert sorted((r.episode, r.camera) for r in low.collect()) == [(e, c) for e in (1, 3, 5) for c in ("a", "b")]
    some = sorted(r.episode for r in E.pick(rows, 0, 4, "random").collect())
    assert some == sorted(r.episode for r in E.pick(rows.repartition(5), 0, 4, "random").collect()) and len(some) == 8 and len(set(some)) == 4
    with pytest.raises(ValueError):
        E.pick(rows, 0, 3, "best")


def test_parsing():
    assert S.parse_limits(["acc_arm_p99>18", "ldlj_wrist < -20:review"]) == [S.Rule("acc_arm_p99", 18.0), S.Rule("ldlj_wrist", -20.0, "<", "review")]
    for bad in ("acc_arm_p99=3", "speed>3", "acc_arm_p99>x"):
        with pytest.raises(ValueError):
            S.parse_limits([bad])
    assert S.parse_weights(" smoothness = 0.5,,video=0") == S.WEIGHTS | {"smoothness": 0.5, "video": 0.0} and S.parse_weights(None) == S.WEIGHTS
    with pytest.raises(ValueError):
        S.parse_weights("speed=1")


def test_refit_keeps_the_threshold(spark):
    from episodica.plans import bindings

    d = bindings.measures(spark, SF)
    p = fit.refit_profile(d, fit.Profile(threshold=0.8), task_duration=9.0, fitted_on="here")
    assert p.threshold == 0.8 and p.task_duration_s == 9.0 and p.fitted_on == "here" and p.n_episodes_fitted > 0
    assert fit.refit_profile(d).threshold == fit.Profile().threshold
    assert fit.Profile.from_json(p.to_json()) == p


@pytest.mark.parametrize("size", [3, 5, 9, 11])
def test_blur_is_numpy(spark, size):
    h, w = 7, 9
    img = np.random.default_rng(size).integers(0, 256, (h, w))
    half, k = size // 2, np.array(G.gaussian(size))
    assert math.isclose(k.sum(), 1)
    pad = np.pad(img.astype(float), half, mode="reflect")
    want = sum(k[i] * k[j] * pad[i : i + h, j : j + w] for i in range(size) for j in range(size))
    d = spark.createDataFrame([(img.ravel().tolist(), h, w)], "g array<int>, h int, w int")
    got = np.array(d.select(G.blur(F.col("g"), "h", "w", size)).first()[0]).reshape(h, w)
    assert np.abs(got - want).max() <= 0.5 + 1e-6


def test_image_faults(spark):
    rows = [(e, "top", i, 4, 4, [100] * 16) for e in range(30) for i in range(3)]
    d = spark.createDataFrame(rows, "episode long, camera string, frame_index int, height int, width int, gray array<int>")
    got = inject.image_faults(d, 0.5).collect()
    hit = {r.episode for r in got if r.corrupted}
    assert 0 < len(hit) < 30
    for r in got:
        # a flat image stays flat; 100 moves by a quarter and 25 at most
        assert len(set(r.gray)) == 1 and (r.gray[0] == 100 if r.episode not in hit else 50 <= r.gray[0] <= 150)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, inject.image_faults(d.repartition(5), 0.5).collect()), key=repr)
    assert not any(r.corrupted for r in inject.image_faults(d, 0.0).collect())


def test_single_precision(spark):
    d = spark.createDataFrame([([0.1], 1)], "`observation.state` array<double>, x int")
    assert dict(inject.single_precision(d).dtypes) == {"observation.state": "array<float>", "x": "int"}


def test_chains_are_those_of_names(spark):
    from episodica.operators import measure as M

    names = ["left_arm", "Right_Shoulder", "waist", "LEG_knee", "spine_arm", "head", ""]
    d = spark.createDataFrame([(n,) for n in names], "n string")
    for r in d.select("n", *[c.alias(k) for k, c in M.chains(F.col("n")).items()]).collect():
        assert {"arm": r.arm, "body": r.body} == M.chain_of(r.n)

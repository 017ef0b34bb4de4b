"""Queries read whole texts and return rows for every episode: brute force where SQL is unfit."""

import json

import numpy as np
from pyspark.sql import functions as F

from episodica import plans
from episodica.operators import measure as M
from episodica.operators import score as S
from episodica.sources import video

SF = "/root/testdata/sf0.001"


def brace_scan(text):
    """The last object of a text, by depth from each brace; plain and slow."""
    for begin in reversed([i for i, c in enumerate(text) if c == "{"]):
        depth, outer = 0, not open_before(text, begin)
        for i in range(begin, len(text)):
            depth += {"{": 1, "}": -1}.get(text[i], 0)
            if depth == 0:
                break
        if outer and depth == 0:
            try:
                return json.dumps(json.loads(text[begin : i + 1].replace(", }", "}")))
            except ValueError:
                continue
    end = text.rfind("}")
    for begin in reversed([i for i, c in enumerate(text[:end]) if c == "{"]):
        try:
            return json.dumps(json.loads(text[begin : end + 1].replace(", }", "}")))
        except ValueError:
            continue
    return None


def open_before(text, at):
    """Whether a brace is open at the place; closing ones that match nothing don't count."""
    depth = 0
    for c in text[:at]:
        depth = depth + 1 if c == "{" else max(0, depth - (c == "}"))
    return depth > 0


def test_json_last_object_reads_whole_texts(spark, tmp_path):
    far = "word " * 300
    # A brace left open late in the text keeps the suffix's objects from depth 0, so the last object is one of the text.
    texts = ["short", far, far + '{"late": 1} {', '{"early": 1} ' + far + '{"late": 2} {', '{"early": 3} ' + far + "{", far + '{"late": 1}', far + "{", far + "}}", far + '{"x": {"y": 2}', far + "{" * 5 + "}" * 3, '{"early": 1} ' + far + "{ {", "", None]
    rows = [(i, i % 3, "user", t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r.last for r in plans.queries()["json_last_object"](spark, str(tmp_path)).collect()}
    for i, turn, _, t in rows:
        want = None if t is None else brace_scan(f'{t} {{"a": {{"turn": {turn}}}, }} tail {{"score": 1}}')
        assert got[i] == want, i


def test_decision_reasons_all_explains_every_episode(spark):
    rows = plans.queries()["decision_reasons_all"](spark, SF).collect()
    episodes = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").distinct().count()
    assert len(rows) == len({(r.episode, r.mode) for r in rows}) == 3 * episodes
    said = {x.split()[0] for r in rows for x in r.reasons}
    assert said >= {"flag:degenerate", "limit:max_base_tilt_deg>22", "semantic:goal", "smoothness", "timing", "video", "score", "arm", "idle", "flag:video_frozen", "contact", "semantic"}
    assert any(not r.reasons for r in rows)


def test_reasons_of_a_review(spark):
    base = spark.range(1).select(*[F.lit(False).alias(f) for f in M.HARD + M.SOFT], *[F.lit(0.4).alias(f) for f in S.FAMILIES], F.lit(0.4).alias("total"), F.lit(0.6).alias("contact_rate_hz"), F.lit(5).alias("contact_count"), F.lit(0.5).alias("semantic"))
    assert S.decide(base, S.Policy(mode="weighted", minimums={"timing": 0.5})).first().reasons == ["timing 0.400 < 0.5", "contact 5 events (0.60 Hz)", "semantic 0.5"]
    assert S.decide(base.drop("contact_count")).first().reasons == ["contact (0.60 Hz)", "semantic 0.5"]


def test_criteria_rows_all_ranks_every_episode(spark):
    rows = plans.queries()["criteria_rows_all"](spark, SF).collect()
    places = {}
    for r in rows:
        places.setdefault(r.episode, []).append(r.place)
    assert len(places) == spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").distinct().count()
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())
    one = {(r.quantity, r.value, r.p, r.place) for r in plans.queries()["criteria_rows"](spark, SF).collect()}
    assert one == {(r.quantity, r.value, r.p, r.place) for r in rows if r.episode == min(places)}


def test_decided_reindex_keeps_what_the_rules_keep(spark):
    frames = [(r.user_id, r.n) for r in spark.read.parquet(f"{SF}/events.parquet").groupBy("user_id").agg(F.count("*").alias("n")).collect()]
    kept = {r.episode for r in plans.queries()["decide_rules"](spark, SF).where("decision <> 'reject'").collect()} & {e for e, _ in frames}
    assert any(e % 3 == 0 for e in kept) and len(kept) < len(frames)
    meta = {r.episode: r.length for r in plans.queries()["reindex_meta_decided"](spark, SF).collect()}
    assert meta == dict(enumerate(n for e, n in sorted(frames) if e in kept))
    rows = plans.queries()["reindex_frames_decided"](spark, SF).collect()
    assert sorted(r["index"] for r in rows) == list(range(sum(meta.values())))


def test_video_measures_of_decoded_frames(spark):
    rng = np.random.default_rng(3)
    near, wide = rng.integers(0, 256, (35, 4, 5)), rng.integers(0, 256, (3, 2, 320))
    rows = [(1, "a", i, 40, 4, 5, g.ravel().tolist()) for i, g in enumerate(near)] + [(2, "a", i, 0, 2, 320, g.ravel().tolist()) for i, g in enumerate(wide)]
    decoded = spark.createDataFrame(rows, "episode long, camera string, frame_index int, declared int, height int, width int, gray array<int>")
    segments = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "episode long, camera string")
    got = {r.episode: r for r in M.video(decoded, segments).collect()}
    some = near[::2]
    pad = np.pad(some, ((0, 0), (1, 1), (1, 1)), mode="reflect")
    lap = pad[:, :-2, 1:-1] + pad[:, 2:, 1:-1] + pad[:, 1:-1, :-2] + pad[:, 1:-1, 2:] - 4 * some
    want = [35 / 40, lap.var(axis=(1, 2)).mean(), some.mean(), some.std(axis=(1, 2)).mean(), ((some > 250) | (some < 5)).mean(), np.abs(np.diff(near, axis=0)).mean()]
    names = ["decode_ratio", "sharpness", "brightness", "contrast", "clipped_fraction", "interframe_diff"]
    assert np.allclose([got[1][f"video_{k}"] for k in names], want)
    pairs = np.floor(wide.reshape(3, 2, 160, 2).sum(axis=(1, 3)) / 4 + 0.5)
    assert np.isclose(got[2].video_interframe_diff, np.abs(np.diff(pairs, axis=0)).mean())
    assert got[2].video_decode_ratio == 1 and got[2].video_brightness == wide[0].mean()
    assert (got[3].video_decodable, got[3].video_decode_ratio, got[3].video_sharpness) == (False, 0.0, None)


def test_folded_video_is_the_video(spark):
    """Clips folded where they are decoded, in whichever segments, have the measures of all their frames; no image is shuffled."""
    rng = np.random.default_rng(8)
    clips = {1: rng.integers(0, 256, (45, 4, 5)), 2: rng.integers(0, 256, (19, 3, 170)), 3: rng.integers(0, 256, (1, 2, 2)), 4: rng.integers(0, 256, (33, 6, 2))}
    declared = {1: 45, 2: 0, 3: 1, 4: 400}
    rows = [(e, "a", i, declared[e], *g.shape, g.ravel().tolist()) for e, gs in clips.items() for i, g in enumerate(gs)]
    decoded = spark.createDataFrame(rows, "episode long, camera string, frame_index int, declared int, height int, width int, gray array<int>")
    frames = {e: [r[2:] for r in rows if r[0] == e] for e in clips}

    def decoder(path, from_s, to_s):
        yield from (f for f in frames[int(path)] if from_s <= f[0] < to_s)

    cuts = {1: [0, 7, 23, 24, 45], 2: [0, 19], 3: [0, 1], 4: [0, 16, 33], 5: [0, 1]}
    frames[5] = []
    segments = spark.createDataFrame([(e, "a", str(e), float(a), float(b)) for e, c in cuts.items() for a, b in zip(c, c[1:])], "episode long, camera string, path string, from_s double, to_s double")
    runs = video.fold(segments, decoder, M.DIFF_WIDTH, M.SAMPLES)
    got, want = M.video_of(runs, segments), M.video(decoded, segments)
    assert got.columns == want.columns
    names = [c for c in want.columns if c.startswith("video_")]
    for a, b in zip(got.orderBy("episode").collect(), want.orderBy("episode").collect(), strict=True):
        assert a.episode == b.episode and all((a[c] is None) == (b[c] is None) and (a[c] is None or np.isclose(float(a[c]), float(b[c]))) for c in names), (a, b)
    assert "array<int>" not in {kind for _, kind in runs.dtypes}
    per = spark.createDataFrame([(e, 5.0, 1.0, 1.0, 4, 0.5) for e in (1, 4, 5, 6)], "episode long, duration_s double, eef_path_m double, max_speed double, grasp_transitions int, min_wrist_separation_m double")
    flagged = {r.episode: r for r in M.with_video(M.flag(per), got, "a").collect()}
    assert {e: (r.video_unreadable, r.video_truncated, r.valid) for e, r in flagged.items()} == {1: (False, False, True), 4: (False, True, False), 5: (True, False, False), 6: (False, False, True)}


def test_humanoid_by_hand(spark):
    """Worked out by hand from the default ranges."""
    import math

    from episodica.operators import legacy

    names = "ldlj_wrist ldlj_arm ldlj_body acc_arm_rms acc_arm_p99 acc_body_rms acc_body_p99 acc_wrist_rms acc_wrist_p99 contact_rate_hz duration_s idle_fraction".split()
    kinds = ", ".join(f"{n} double" for n in names)
    video = {"video_sharpness": 84.0, "video_brightness": 127.5, "video_contrast": 45.0, "video_clipped_fraction": 0.0, "video_interframe_diff": 2.0, "arm_speed_rms": 0.0}
    schema = f"episode int, {kinds}, grasp_transitions int, grasp_incomplete boolean, self_collision_suspect boolean, degenerate boolean, video_decodable boolean, video_truncated boolean, " + ", ".join(f"{k} double" for k in video)
    half = [-18.35, -18.95, -19.95, 4.5, 17.3, 2.05, 7.05, 2.65, 8.95, 0.5, 22.0, 0.4]
    rows = [
        (1, *half, 4, False, False, False, True, False, *video.values()),
        (2, *half, 4, True, True, False, None, None, *[None] * 6),
        (3, *half, 4, False, False, True, True, True, *video.values()),
        (4, *half[:3], *[None] * 6, *half[9:], -1, False, False, False, None, None, *[None] * 6),
    ]
    got = {r.episode: r for r in legacy.humanoid(spark.createDataFrame(rows, schema), (18.0, 4.0)).collect()}
    slow = math.exp(-((1 / 1.25) ** 2))
    near = lambda a, b: abs(a - b) < 1e-9
    assert near(got[1].h_smoothness, 0.5) and near(got[1].h_acceleration, 0.5) and near(got[1].h_collision, math.exp(-1))
    assert near(got[1].h_runtime, 0.5 * slow + 0.3 * 0.6 + 0.2) and near(got[1].h_visual, 0.45 * 0.5 + 0.30 + 0.25 * 0.5)
    assert near(got[1].aggregate, (0.5 + 0.5 + math.exp(-1) + 0.5 * slow + 0.38 + 0.65) / 5)
    assert near(got[2].h_collision, 0.2) and near(got[2].h_runtime, 0.5 * slow + 0.18) and got[2].h_visual is None
    assert near(got[2].aggregate, (0.5 + 0.5 + 0.2 + 0.5 * slow + 0.18) / 4)
    assert got[3].aggregate == 0
    assert near(got[4].h_acceleration, 0) and near(got[4].h_runtime, 0.5 * slow + 0.18 + 0.2)


def test_reasons_of_absolute_decisions(spark):
    from episodica.operators import fit, score

    c = lambda q, action, weight, unit="": fit.Criterion(quantity=q, good=1.0, bad=2.0, weight=weight, action=action, family="x", label=q.upper(), unit=unit)
    profile = fit.Profile(criteria=(c("a", "reject", 1.0, "s"), c("b", "reject", 2.0), c("k", "review", 1.0, "Hz")), threshold=0.5)
    flags = ", ".join(f"{f} boolean" for f in (*score.HARD, *score.SOFT))
    off = [False] * (len(score.HARD) + len(score.SOFT))
    rows = [(1, 1.9, 1.8, 1.0, 1.0, None, *off), (2, 1.0, 1.0, 1.9, 0.5, None, *off), (3, 1.0, 1.0, 1.0, 0.0, "cup fell", *off), (4, None, None, None, 1.0, "", *off), (5, 1.0, 1.0, 1.0, 1.0, "", *off)]
    df = spark.createDataFrame(rows, f"episode int, a double, b double, k double, semantic double, semantic_note string, {flags}")
    got = {r.episode: (r.decision, r.reasons) for r in score.decide_absolute(score.score_absolute(df, profile), profile).collect()}
    assert got[1][0] == "reject" and got[1][1][0].startswith("score 0.0") and [t.split(" (")[0] for t in got[1][1][1:]] == ["B 1.8", "A 1.9 s"]
    assert got[2] == ("review", ["K 1.9 Hz", "semantic 0.5"]) and got[3] == ("reject", ["semantic:goal not reached: cup fell"])
    assert got[4] == ("review", ["no criterion measurable on this episode"]) and got[5] == ("accept", [])

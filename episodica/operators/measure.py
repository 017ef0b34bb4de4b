"""Episode measurement: frames in, one row of physical quantities and flags out.

Frames have episode, frame_index, t (seconds) and the channels state, action,
eef, gravity, left_hand and right_hand (arrays of double, any but state NULL).
Every window and aggregation starts its keys with the episode, so one exchange
by episode serves them all.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import gray as G
from ..functions import kernels as K

#: The joint layout, and the words that put a group into a chain.
GROUPS = {"left_leg": (0, 6), "right_leg": (6, 12), "waist": (12, 15), "left_arm": (15, 22), "right_arm": (29, 36)}
ARM_WORDS = ("arm", "shoulder", "elbow", "wrist")
BODY_WORDS = ("leg", "waist", "torso", "hip", "knee", "ankle", "spine")
#: Thresholds in physical units.
ACTIVE_STD, MIN_PATH, MIN_SEPARATION, IDLE_FLOOR, IDLE_SHARE = 1e-6, 0.30, 0.10, 0.10, 0.05
HAND_CLOSED, HAND_BAND, MIN_TRANSITIONS, QUORUM, DECODE_RATIO, FREEZE = 300.0, 60.0, 2, 2, 0.95, 1.0
#: Sampled frames of a video, and the width at which neighbours are compared.
SAMPLES, DIFF_WIDTH = 16, 160


def ep() -> WindowSpec:
    return W.partitionBy("episode")


def by_t() -> WindowSpec:
    return W.partitionBy("episode").orderBy("t", "frame_index")


def by_joint() -> WindowSpec:
    return W.partitionBy("episode", "joint").orderBy("t", "frame_index")



def chain_of(group: str) -> dict[str, bool]:
    name = group.lower()
    return {"arm": any(w in name for w in ARM_WORDS), "body": any(w in name for w in BODY_WORDS)}


def chains(name: Column) -> dict[str, Column]:
    """Whether a group's name belongs to the arm and to the body chain."""
    return {"arm": F.lower(name).rlike("|".join(ARM_WORDS)), "body": F.lower(name).rlike("|".join(BODY_WORDS))}


def in_chain(chain: str, groups: Mapping[str, tuple[int, int]]) -> Column:
    """Whether ``joint`` lies in a group of the chain."""
    out = F.lit(False)
    for name, (a, b) in groups.items():
        if chain_of(name)[chain]:
            out = out | ((F.col("joint") >= a) & (F.col("joint") < b))
    return out


def joint_samples(frames: DataFrame) -> DataFrame:
    """A row per frame and joint: q, the command, velocity, acceleration, jerk and whether the joint is alive."""
    rows = frames.select("episode", "frame_index", "t", F.posexplode("state").alias("joint", "q"), "action", F.size("state").alias("width"))
    rows = rows.withColumn("q", K.clean(F.col("q"))).withColumn("command", F.when(F.size("action") == F.col("width"), F.get("action", "joint"))).drop("action", "width")
    rows = rows.withColumn("alive", F.coalesce(F.stddev_pop("q").over(W.partitionBy("episode", "joint")) > ACTIVE_STD, F.lit(False)))
    for src, out in (("q", "v"), ("v", "a"), ("a", "j")):
        rows = rows.withColumn(out, K.gradient(F.col(src), F.col("t"), by_joint()))
    return rows


def per_frame(samples: DataFrame, groups: Mapping[str, tuple[int, int]] = GROUPS) -> DataFrame:
    """A row per frame: joint speed and each chain's speed, jerk energy and tracking residual."""
    s = samples.withColumn("lag_q", F.col("command") - F.col("q"))
    s = s.withColumn("res", F.col("lag_q") - F.percentile("lag_q", F.lit(0.5)).over(W.partitionBy("episode", "joint")))
    alive = F.col("alive")
    aggs = [F.sqrt(F.coalesce(F.sum(F.when(alive, F.col("v") * F.col("v"))), F.lit(0.0))).alias("speed")]
    for chain in ("arm", "body"):
        mine = alive & in_chain(chain, groups)
        aggs += [F.sqrt(F.sum(F.when(mine, F.col("v") * F.col("v")))).alias(f"{chain}_speed"), F.sum(F.when(mine, F.col("j") * F.col("j"))).alias(f"{chain}_jerk2")]
    aggs.append(F.sqrt(F.sum(F.when(alive & in_chain("arm", groups), F.col("res") * F.col("res")))).alias("residual"))
    return s.groupBy("episode", "frame_index", "t").agg(*aggs)


def ldlj(speed: str, jerk2: str) -> list[Column]:
    """Aggregates of one episode's frames: minus the log of the dimensionless jerk integral."""
    span = F.max("t") - F.min("t")
    peak = F.max(speed)
    integral = F.sum(F.col(f"{jerk2}_area"))
    value = -F.ln(F.pow(span, F.lit(3)) / (peak * peak) * integral)
    return F.when((F.count(speed) >= 4) & (span > 0) & (peak > 1e-9) & (integral > 0), value)


def with_area(frames: DataFrame, col: str) -> DataFrame:
    """Adds the trapezoid between each frame and the one before."""
    return frames.withColumn(f"{col}_area", (F.col("t") - F.lag("t").over(by_t())) * (F.col(col) + F.lag(col).over(by_t())) / 2)


def wrist_frames(frames: DataFrame) -> DataFrame:
    """A row per frame: step, speed, acceleration and jerk of each wrist, separation, tilt and hand closure."""
    d = frames.select("episode", "frame_index", "t", "eef", "gravity", "left_hand", "right_hand")
    for side, at in (("left", 0), ("right", 7)):
        wide = F.size("eef") >= at + 3
        for k in range(3):
            d = d.withColumn(f"{side}{k}", F.when(wide, K.clean(F.get("eef", F.lit(at + k)))))
        for src, out in (("", "_v"), ("_v", "_a"), ("_a", "_j")):
            for k in range(3):
                d = d.withColumn(f"{side}{k}{out}", K.gradient(F.col(f"{side}{k}{src}"), F.col("t"), by_t()))
        d = d.withColumn(f"{side}_step", K.norm(*[F.col(f"{side}{k}") - F.lag(f"{side}{k}").over(by_t()) for k in range(3)]))
        for name, out in (("speed", "_v"), ("acc", "_a"), ("jerk", "_j")):
            d = d.withColumn(f"{side}_{name}", K.norm(*[F.col(f"{side}{k}{out}") for k in range(3)]))
    d = d.withColumn("separation", K.norm(*[F.col(f"left{k}") - F.col(f"right{k}") for k in range(3)]))
    for k in range(3):
        d = d.withColumn(f"g{k}", K.clean(F.get("gravity", F.lit(k))))
        d = d.withColumn(f"g{k}_v", K.gradient(F.col(f"g{k}"), F.col("t"), by_t()))
        d = d.withColumn(f"g{k}_a", K.gradient(F.col(f"g{k}_v"), F.col("t"), by_t()))
    size = K.norm(*[F.col(f"g{k}") for k in range(3)])
    d = d.withColumn("tilt", F.degrees(F.acos(K.clip(-F.col("g2") / F.when(size > 1e-9, size).otherwise(1e-9), -1, 1))))
    d = d.withColumn("base_acc", K.norm(*[F.col(f"g{k}_a") for k in range(3)]))
    left, right = F.sum("left_step").over(ep()), F.sum("right_step").over(ep())
    d = d.withColumn("left_path", left).withColumn("right_path", right)
    d = d.withColumn("side", F.when(F.col("left_path").isNull(), "right").when(F.coalesce(F.col("right_path") > F.col("left_path"), F.lit(False)), "right").otherwise("left"))
    on_left = F.col("side") == "left"
    for c in ("path", "speed", "acc", "jerk"):
        d = d.withColumn(f"wrist_{c}", F.when(on_left, F.col(f"left_{c}")).otherwise(F.col(f"right_{c}")))
    hand = F.when(on_left, F.coalesce("left_hand", "right_hand")).otherwise(F.coalesce("right_hand", "left_hand"))
    four = F.slice(hand, 1, 4)
    d = d.withColumn("closure", F.aggregate(four, F.lit(0.0), lambda a, x: a + x) / F.size(four))
    return d.select("episode", "frame_index", "t", "side", "wrist_path", "wrist_speed", "wrist_acc", "wrist_jerk", "separation", "tilt", "base_acc", "closure")


def contact_frames(frame: DataFrame) -> DataFrame:
    """Adds the three votes, whether a contact is confirmed, and its start."""
    n = F.count("*").over(ep())
    slowing = K.gradient(F.col("wrist_speed"), F.col("t"), by_t()) < 0
    moving = F.col("wrist_speed") > F.greatest(F.percentile("wrist_speed", F.lit(0.25)).over(ep()), F.lit(1e-3))
    d = frame.withColumn("impact", F.coalesce(K.spikes(F.col("wrist_acc"), ep()) & slowing & moving, F.lit(False)))
    d = d.withColumn("base_vote", K.spikes(F.col("base_acc"), ep()) & (n > 2)).withColumn("tracking_vote", K.spikes(F.col("residual"), ep()))
    votes = F.col("impact").cast("int") + F.col("base_vote").cast("int") + F.col("tracking_vote").cast("int")
    d = d.withColumn("confirmed", votes >= QUORUM)
    return d.withColumn("starts", K.run_starts(F.col("confirmed"), by_t())).withColumns({f"{v}_starts": K.run_starts(F.col(c), by_t()) for v, c in (("impact", "impact"), ("base", "base_vote"), ("tracking", "tracking_vote"))})


def measure(frames: DataFrame, groups: Mapping[str, tuple[int, int]] = GROUPS) -> DataFrame:
    """One row per episode with every quantity and the flags that need no video."""
    samples = joint_samples(frames)
    frame = per_frame(samples, groups).join(wrist_frames(frames).withColumn("wrist_jerk2", F.col("wrist_jerk") * F.col("wrist_jerk")), ["episode", "frame_index", "t"])
    for c in ("arm_jerk2", "body_jerk2", "wrist_jerk2"):
        frame = with_area(frame, c)
    frame = contact_frames(frame)
    frame = frame.withColumn("idle_bar", F.greatest(F.lit(IDLE_FLOOR), IDLE_SHARE * F.percentile("speed", F.lit(0.95)).over(ep())))
    frame = frame.withColumn("closed", F.when(F.col("closure").isNotNull(), K.hysteresis(F.col("closure"), by_t(), HAND_CLOSED, HAND_BAND)))
    frame = frame.withColumn("switch", (F.col("closed") != F.lag("closed").over(by_t())).cast("int")).withColumn("step", F.col("t") - F.lag("t").over(by_t()))
    n, span = F.count("*"), F.max("t") - F.min("t")
    per = frame.groupBy("episode").agg(
        n.alias("n_frames"), span.alias("duration_s"), F.coalesce(F.try_divide(F.lit(1.0), F.percentile("step", F.lit(0.5))), F.lit(0.0)).alias("fps"),
        F.first("side").alias("side"), F.first("wrist_path").alias("eef_path_m"),
        ldlj("arm_speed", "arm_jerk2").alias("ldlj_arm"), ldlj("body_speed", "body_jerk2").alias("ldlj_body"), ldlj("wrist_speed", "wrist_jerk2").alias("ldlj_wrist"),
        K.rms(F.col("wrist_acc")).alias("acc_wrist_rms"), F.percentile("wrist_acc", F.lit(0.99)).alias("acc_wrist_p99"),
        F.sum(F.col("starts").cast("int")).alias("contact_count"), F.sum(F.col("impact_starts").cast("int")).alias("impact_count"),
        F.sum(F.col("base_starts").cast("int")).alias("base_disturbance_count"), F.sum(F.col("tracking_starts").cast("int")).alias("tracking_divergence_count"),
        F.coalesce(F.try_divide(F.sum(F.col("starts").cast("int")).cast("double"), span), F.lit(0.0)).alias("contact_rate_hz"),
        F.array_sort(F.collect_list(F.when(F.col("starts"), F.col("frame_index")))).alias("contact_frames"),
        F.min("separation").alias("min_wrist_separation_m"), F.max("tilt").alias("max_base_tilt_deg"),
        F.avg((F.col("speed") < F.col("idle_bar")).cast("double")).alias("idle_fraction"), F.max("speed").alias("max_speed"),
        F.when(F.count("closure") > 0, F.coalesce(F.sum("switch"), F.lit(0))).otherwise(-1).cast("int").alias("grasp_transitions"),
    )
    per = per.withColumn("contact_phases", F.transform("contact_frames", lambda i: i / F.greatest(F.col("n_frames") - 1, F.lit(1)))).drop("contact_frames")
    return flag(per.join(accelerations(samples, groups), "episode", "left"))


def accelerations(samples: DataFrame, groups: Mapping[str, tuple[int, int]] = GROUPS) -> DataFrame:
    """Pooled acceleration statistics of the chains and an RMS for each group."""
    alive, aggs = F.col("alive"), []
    for chain in ("arm", "body"):
        a = F.when(alive & in_chain(chain, groups), F.col("a"))
        aggs += [K.rms(a).alias(f"acc_{chain}_rms"), F.percentile(F.abs(a), F.lit(0.99)).alias(f"acc_{chain}_p99")]
    aggs.append(K.rms(F.when(alive & in_chain("arm", groups), F.col("v"))).alias("arm_speed_rms"))
    for name, (lo, hi) in groups.items():
        aggs.append(K.rms(F.when(alive & (F.col("joint") >= lo) & (F.col("joint") < hi), F.col("a"))).alias(f"acc_{name}_rms"))
    return samples.groupBy("episode").agg(*aggs)


def video(decoded: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """The video_* columns by episode and camera, from rows of ``sources.video.decode``.

    Appearance is taken from every step-th frame, the difference from all neighbours.
    segments: its episodes and cameras without a frame become undecodable.
    """
    keys = ["episode", "camera"]
    w = W.partitionBy(*keys).orderBy("frame_index")
    d = decoded.withColumn("i", F.row_number().over(w) - 1).withColumn("small", G.shrink("gray", "height", "width", DIFF_WIDTH)).withColumn("prev", F.lag("small").over(w))
    step = F.when(F.col("declared") > 0, F.greatest(F.floor(F.col("declared") / SAMPLES), F.lit(1))).otherwise(25)
    take = lambda c: F.avg(F.when(F.col("i") % step == 0, c))
    g, n, declared = F.col("gray"), F.count("*"), F.max("declared")
    out = d.groupBy(*keys).agg(
        F.lit(True).alias("video_decodable"), F.when(declared > 0, n / declared).otherwise(1.0).alias("video_decode_ratio"),
        take(G.variance(G.laplacian("gray", "height", "width"))).alias("video_sharpness"), take(G.mean(g)).alias("video_brightness"),
        take(F.sqrt(F.greatest(G.variance(g), F.lit(0.0)))).alias("video_contrast"), take(G.clipped(g)).alias("video_clipped_fraction"),
        F.avg(G.mean_abs_difference(F.col("small"), F.col("prev"))).alias("video_interframe_diff"), n.alias("video_frames_decoded"), declared.cast("long").alias("video_frames_declared"),
    )
    return _undecoded(out, segments)


def _undecoded(out: DataFrame, segments: DataFrame | None) -> DataFrame:
    """With segments: those without any frame are undecodable."""
    if segments is None:
        return out
    keys = ["episode", "camera"]
    out = segments.select(*keys).distinct().join(out, keys, "left")
    none = {"video_decodable": F.lit(False), "video_decode_ratio": F.lit(0.0), "video_frames_decoded": F.lit(0).cast("long")}
    return out.withColumns({c: F.coalesce(c, v) for c, v in none.items()})


def video_of(runs: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """The columns of ``video`` from rows of ``sources.video.fold``: no image passes an exchange.

    Only outer frames of runs do, a few thousand bytes for each ``RUN`` frames.
    """
    keys = ["episode", "camera"]
    w = W.partitionBy(*keys).orderBy("at")
    d = runs.withColumn("before", F.lag("last").over(w))
    d = d.withColumn("across", F.pandas_udf(_across, "double")("before", "first"))
    n, declared, sampled = F.sum("n"), F.max("declared"), F.sum("sampled")
    mean = lambda c: F.try_divide(F.sum(c), sampled)
    diff = F.try_divide(F.sum("diff") + F.coalesce(F.sum("across"), F.lit(0.0)), F.sum("diffs") + F.count("across"))
    out = d.groupBy(*keys).agg(
        F.lit(True).alias("video_decodable"), F.when(declared > 0, n / declared).otherwise(1.0).alias("video_decode_ratio"), mean("sharpness").alias("video_sharpness"),
        mean("brightness").alias("video_brightness"), mean("contrast").alias("video_contrast"), mean("clipped").alias("video_clipped_fraction"), diff.alias("video_interframe_diff"),
        n.alias("video_frames_decoded"), declared.cast("long").alias("video_frames_declared"),
    )
    return _undecoded(out, segments)


def _across(before: pd.Series, after: pd.Series) -> pd.Series:
    """The mean differences of pairs of shrunk frames; none where a frame is missing or their sizes differ."""
    pairs = [None if a is None or len(a) != len(b) else (np.frombuffer(a, "<f8"), np.frombuffer(b, "<f8")) for a, b in zip(before, after, strict=True)]
    return pd.Series([None if p is None else float(np.abs(p[0] - p[1]).mean()) for p in pairs], dtype="float64")


def with_video(per: DataFrame, video_: DataFrame, camera: str) -> DataFrame:
    """Measured rows with one camera's video columns, flagged anew; episodes without that camera keep NULL."""
    flags = {*HARD, *SOFT, "valid", "needs_review", "raised"}
    bare = per.select(*[c for c in per.columns if c not in flags and not c.startswith("video_")])
    return flag(bare.join(video_.where(F.col("camera") == camera).drop("camera"), "episode", "left"))


#: The flags, in the order in which they are reported.
HARD = ("degenerate", "grasp_incomplete", "video_unreadable", "video_truncated")
SOFT = ("self_collision_suspect", "video_frozen")


def flag(per: DataFrame) -> DataFrame:
    """Adds the six flags, valid, needs_review and the raised flags in order."""
    has = lambda c, kind: F.col(c) if c in per.columns else F.lit(None).cast(kind)
    decodable = has("video_decodable", "boolean")
    d = per.withColumn("degenerate", (F.col("duration_s") <= 0) | F.coalesce(F.col("eef_path_m") < MIN_PATH, F.col("max_speed") < 1e-3, F.lit(False)))
    d = d.withColumn("grasp_incomplete", F.col("grasp_transitions").between(0, MIN_TRANSITIONS - 1))
    d = d.withColumn("self_collision_suspect", F.coalesce(F.col("min_wrist_separation_m") < MIN_SEPARATION, F.lit(False)))
    d = d.withColumn("video_unreadable", F.coalesce(~decodable, F.lit(False))).withColumn("video_truncated", F.coalesce(decodable & (has("video_decode_ratio", "double") < DECODE_RATIO), F.lit(False)))
    d = d.withColumn("video_frozen", F.coalesce(decodable & (has("video_interframe_diff", "double") < FREEZE), F.lit(False)))
    return status(d)


def status(d: DataFrame) -> DataFrame:
    """Adds valid (no hard flag), needs_review (a soft one) and raised from the six flags."""
    any_of = lambda names: F.greatest(*[F.coalesce(F.col(c), F.lit(False)) for c in names])
    return d.withColumn("valid", ~any_of(HARD)).withColumn("needs_review", any_of(SOFT)).withColumn("raised", F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in HARD + SOFT])))

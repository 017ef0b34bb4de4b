"""The single-tier scores of earlier datasets, one value per episode.

Input rows are joint samples in long form: episode, frame_index, t, joint, q and
command. NULL stands for "can't be told".
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import kernels as K
from ..functions.kernels import clip
from . import fit, score
from .measure import by_joint, ep
from .selection import dealt, percentiles, small

#: The earlier interface's weights and the good/bad cut.
WEIGHTS = {"visual_clarity": 20, "smoothness": 10, "collision": 10, "runtime": 20, "actuator_saturation": 10}
GOOD = 0.65


def _steps(samples: DataFrame) -> DataFrame:
    w = by_joint()
    d = samples.withColumn("dt", F.col("t") - F.lag("t").over(w)).withColumn("dq", F.col("q") - F.lag("q").over(w))
    return d.withColumn("acc", F.try_divide(F.col("dq") - F.lag("dq").over(w), F.lag("dt").over(w) * F.lag("dt").over(w)))


def path_scores(samples: DataFrame) -> DataFrame:
    """smoothness, path efficiency, idle velocity, collision, stability and saturation of each episode."""
    d = _steps(samples).withColumn("med", F.percentile(F.abs("acc"), F.lit(0.5)).over(W.partitionBy("episode", "joint")))
    d = d.withColumn("spike", F.abs("acc") > 15 * F.col("med")).withColumn("end", F.max("t").over(ep()))
    d = d.withColumn("miss", F.abs(F.col("command") - F.lead("q").over(by_joint())) > 7)
    d = d.withColumn("late", F.when(F.col("t") >= F.col("end") - 2, F.col("q")))
    joint = d.groupBy("episode", "joint").agg(F.stddev_pop("late").alias("late"), F.min_by("q", F.col("frame_index")).alias("q0"), F.max_by("q", F.col("frame_index")).alias("q1"))
    ends = joint.groupBy("episode").agg(F.avg("late").alias("late"), F.sqrt(F.sum((F.col("q1") - F.col("q0")) * (F.col("q1") - F.col("q0")))).alias("straight"))
    frame = d.groupBy("episode", "frame_index").agg(
        F.sqrt(F.sum(F.col("dq") * F.col("dq"))).alias("step"), F.max("dt").alias("dt"), F.sum(F.col("acc") * F.col("acc")).alias("acc2"), F.count("acc").alias("n_acc"), F.max("spike").alias("spike"), F.max("miss").alias("miss")
    )
    per = frame.groupBy("episode").agg(
        F.exp(-F.sqrt(F.try_divide(F.sum("acc2"), F.sum("n_acc"))) / 1000).alias("smoothness"), F.sum("step").alias("path"),
        (1 - F.avg((F.col("step") / F.col("dt") < 0.1).cast("double"))).alias("idle_velocity"),
        F.greatest(F.lit(0.0), 1 - F.avg(F.when(F.col("n_acc") > 0, F.coalesce("spike", F.lit(False)).cast("double")))).alias("collision"),
        F.exp(-4 * F.avg(F.col("miss").cast("double"))).alias("actuator_saturation"),
    )
    got = per.join(ends, "episode")
    efficiency = F.when(F.col("path") < 1e-6, 0.0).otherwise(clip(F.col("straight") / F.col("path")))
    return got.select("episode", "smoothness", efficiency.alias("path_efficiency"), "idle_velocity", "collision", F.exp(-F.col("late") / 0.05).alias("joint_stability"), "actuator_saturation")


def gripper(grip: Column) -> Column:
    """Aggregate: how often a grip reading and its half-way cut agree; 0.5 without readings."""
    agree = F.avg(((grip != 0) == (grip >= 0.5)).cast("double"))
    return F.coalesce(clip((agree - 0.1) / 0.9), F.lit(0.5))


def spectrum(samples: DataFrame, cutoff_hz: float = 10.0, pad: int = 5) -> DataFrame:
    """episode, joint, k and the magnitude of each bin up to the cutoff and under half the sampling rate.

    samples: episode, joint, i (from 0), n, step (mean seconds between samples; the first bin alone where it is NULL) and v. The
    transform is of ``bins`` = the power of two from pad * n up, filled with zeros, and made as two
    groupings: bins = n1 * n2, first sums over every n2-th sample, turned, then sums over the n2 of
    those. A sample takes part in about the root of bins sums, and no group holds more than its two sums.
    """
    bits = F.length(F.bin(F.col("n") * pad - 1))
    two = lambda b: F.pow(F.lit(2.0), b).cast("long")
    angle = lambda turns, of: F.pmod(turns, of) * (2 * math.pi) / of
    d = samples.withColumns({"bins": two(bits), "n1": two(F.floor(bits / 2)), "n2": two(F.ceil(bits / 2))})
    top = F.greatest(F.lit(0), F.least(F.col("bins") / 2 - 1, F.coalesce(F.floor(cutoff_hz * F.col("bins") * F.col("step")) + 1, F.lit(0)))).cast("long")
    shape = ["episode", "joint", "bins", "n1", "n2", "step", "top"]

    zero = F.lit(0).cast("long")
    d = d.withColumn("top", top).withColumns({"j1": F.floor(F.col("i") / F.col("n2")), "j2": F.col("i") % F.col("n2")})
    d = d.select(*shape, "j1", "j2", "v", F.explode(F.sequence(zero, F.least(F.col("n1") - 1, F.col("top")))).alias("k1"))
    d = d.withColumn("a", angle(F.col("j1") * F.col("k1"), F.col("n1")))
    d = d.groupBy(*shape, "k1", "j2").agg(F.sum(F.col("v") * F.cos("a")).alias("re"), (-F.sum(F.col("v") * F.sin("a"))).alias("im"))

    d = d.select("*", F.explode(F.sequence(zero, F.floor((F.col("top") - F.col("k1")) / F.col("n1")))).alias("k2"))
    d = d.withColumn("k", F.col("k1") + F.col("n1") * F.col("k2")).withColumn("a", angle(F.col("j2") * F.col("k"), F.col("bins")))
    d = d.where(F.coalesce(F.try_divide("k", F.col("bins") * F.col("step")) <= cutoff_hz, F.col("k") == 0))
    d = d.groupBy("episode", "joint", "k").agg(F.sum(F.col("re") * F.cos("a") + F.col("im") * F.sin("a")).alias("re"), F.sum(F.col("im") * F.cos("a") - F.col("re") * F.sin("a")).alias("im"))
    return d.select("episode", "joint", "k", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("magnitude"))


def sparc(frames: DataFrame, cutoff_hz: float = 10.0, pad: int = 5) -> DataFrame:
    """episode, joint, sparc and score: the length of the spectrum's curve up to the last bin over a twentieth of its peak.

    Samples are in the order of frame_index. NULL where a sample or the time between samples can't be told; no row
    for a joint of one sample. A joint that doesn't move has a flat curve, -1.
    """
    w = W.partitionBy("episode", "joint").orderBy("frame_index")
    every = W.partitionBy("episode", "joint")
    d = frames.select("episode", "frame_index", "t", F.posexplode("state").alias("joint", "q")).withColumn("q", K.clean(F.col("q").cast("double")))
    # a sample makes many sums, so a task gets a fixed number of frames
    d = dealt(d, 20_000, "episode", "joint", of=frames)
    d = d.withColumns({"i": F.row_number().over(w).cast("long") - 1, "v": K.slope(F.col("q"), F.col("t"), w)})
    d = d.withColumns({"n": F.count("*").over(every), "step": F.max_by("t", "frame_index").over(every) - F.min_by("t", "frame_index").over(every)})
    d = d.where("n > 1").withColumn("step", F.when(F.col("step") > 0, F.col("step") / (F.col("n") - 1)))
    # NaN goes through every sum of its joint and becomes NULL at the end
    unknown = F.col("v").isNull() | F.col("step").isNull()
    s = spectrum(d.withColumn("v", F.when(unknown, F.lit(float("nan"))).otherwise(F.col("v"))), cutoff_hz, pad)
    by_bin = every.orderBy("k")
    s = s.withColumns({"peak": F.max("magnitude").over(every), "last": F.max("k").over(every), "before": F.lag("magnitude").over(by_bin)})
    scale = F.when(F.col("peak") == 0, F.lit(1.0)).otherwise(F.col("peak"))
    s = s.withColumn("end", F.coalesce(F.max(F.when(F.col("magnitude") / scale > 0.05, F.col("k"))).over(every), F.col("last")))
    rise = (F.col("magnitude") - F.col("before")) / scale
    part = F.when((F.col("k") > 0) & (F.col("k") <= F.col("end")), F.sqrt(F.try_divide(F.lit(1.0), F.col("end") * F.col("end")) + rise * rise))
    arc = F.when(F.max("end") == 0, F.when(~F.isnan(F.max("peak")), F.lit(0.0))).otherwise(K.clean(-F.sum(part)))
    arcs = s.groupBy("episode", "joint").agg(arc.alias("sparc"))
    return arcs.withColumn("score", F.when(F.col("sparc").isNotNull(), F.least(F.exp(0.1 * (F.col("sparc") + 1)), F.lit(1.0))))


def outlier(v: Column, mean: Column, std: Column, q1: Column, q3: Column, how: str = "tukey") -> Column:
    """Beyond 1.5 interquartile ranges, or more than three deviations off (never where the deviation is 0)."""
    if how == "z":
        return F.coalesce((std > 0) & (F.abs(v - mean) / std > 3), F.lit(False))
    return (v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))


def runtime(is_outlier: Column) -> Column:
    return F.when(is_outlier, 0.0).otherwise(1.0)


def time_stats(df: DataFrame, col: str) -> DataFrame:
    p, r = percentiles(df, {col: (F.col(col), (0.25, 0.75, 0.5))}, mean=F.avg(col).cast("double"), std=F.stddev_pop(col))
    m = small(df.sparkSession, [(r["mean"], r["std"], *p[col])], "mean double, std double, q1 double, q3 double, median double")
    return m.withColumn("iqr", F.col("q3") - F.col("q1"))


def robust_time_stats(df: DataFrame, col: str) -> DataFrame:
    """median, scaled median deviation, mean and deviation of the finite values; no row without any."""
    d = df.select(F.col(col).cast("double").alias("v")).where("v is not null and not isnan(v) and abs(v) < double('infinity')")
    p, r = percentiles(d, {"v": (F.col("v"), (0.5,))}, mean=F.avg("v"), std=F.stddev_pop("v"))
    rows = []
    if r["n_v"]:
        (median,) = p["v"]
        off, _ = percentiles(d, {"v": (F.abs(F.col("v") - F.lit(median)), (0.5,))})
        rows = [(median, 1.4826 * off["v"][0], r["mean"], r["std"])]
    return small(df.sparkSession, rows, "median double, mad double, mean double, std double")


def degenerate(duration: Column, path: Column, max_speed: Column, shortest_path: float = 0.30, least_speed: float = 1e-3) -> Column:
    """Nothing happened: no duration, a short wrist path, or without a wrist path no joint that moves."""
    still = F.when(path.isNotNull(), path < shortest_path).otherwise(F.coalesce(max_speed < least_speed, F.lit(False)))
    return F.coalesce(duration <= 0, F.lit(False)) | still


def weighted(scores: Mapping[str, Column], weights: Mapping[str, float] = WEIGHTS) -> Column:
    """Weighted mean over the scores present."""
    total = value = F.lit(0.0)
    for k, s in scores.items():
        if weights.get(k, 0) > 0:
            total = total + F.when(s.isNotNull(), F.lit(float(weights[k]))).otherwise(0.0)
            value = value + F.coalesce(s * weights[k], F.lit(0.0))
    return F.try_divide(value, total)


def evaluate(rows: DataFrame) -> DataFrame:
    """One row: camera rows, episodes and the mean score over camera rows."""
    return rows.agg(F.count("*").alias("n_rows"), F.countDistinct("episode").alias("n_episodes"), F.avg("total").alias("mean"))


def breakdown(rows: DataFrame, scores: Mapping[str, Column], weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """episode, metric, its part of the weighted mean, and its share of what the episode reached."""
    total = float(sum(weights[k] for k in scores))
    each = F.array(*[F.struct(F.lit(k).alias("metric"), (v * float(weights[k])).alias("x")) for k, v in scores.items()])
    reached = F.aggregate("each", F.lit(0.0), lambda a, e: a + F.coalesce(e["x"], F.lit(0.0)))
    d = rows.select("episode", each.alias("each")).select("episode", reached.alias("__reached"), F.inline("each"))
    return d.select("episode", "metric", (F.col("x") / total).alias("contribution"), F.try_divide("x", "__reached").alias("share"))



def clarity(frames: DataFrame, keys: Sequence[str], order: str, step: int = 4) -> DataFrame:
    """keys and score: one less the mean penalty of every step-th grey frame (columns sharpness and brightness)."""
    from ..functions.gray import quality_penalty

    w = W.partitionBy(*keys).orderBy(order)
    d = frames.withColumn("__i", F.row_number().over(w)).where(F.col("__i") % step == 0)
    return d.groupBy(*keys).agg(F.greatest(F.lit(0.0), 1 - F.avg(quality_penalty(F.col("sharpness"), F.col("brightness")))).alias("score"))


def brackets(measures: DataFrame, keys: Sequence[str], low: float = 5.0, high: float = 95.0) -> DataFrame:
    """key, lo and hi: percentiles of each quantity over the valid episodes, by one aggregation."""
    p, r = percentiles(measures.where("valid"), {k: (F.col(k), (low / 100, high / 100)) for k in keys}, rows=F.count("*"))
    return small(measures.sparkSession, [(k, *p[k]) for k in keys] if r["rows"] else [], "key string, lo double, hi double")


def good_episodes(rows: DataFrame, threshold: float = GOOD, require: str = "all", some: bool = False) -> DataFrame:
    """Episodes all (or any) of whose camera rows reach the threshold; with ``some`` it is an error if none does."""
    if require not in ("all", "any"):
        raise ValueError(f"require is 'all' or 'any', not {require!r}")
    ok = F.coalesce(F.col("total") >= threshold, F.lit(False))
    good = rows.groupBy("episode").agg((F.min(ok) if require == "all" else F.max(ok)).alias("good")).where("good").select("episode")
    if some and good.isEmpty():
        raise ValueError(f"no episode's scores reach {threshold}")
    return good


def humanoid(measures: DataFrame, stats: tuple[float, float] | None = None, weights: Mapping[str, float] | None = None) -> DataFrame:
    """Five metrics of earlier humanoid datasets, each the family score without an idle allowance, and their mean.

    stats: median and spread of durations; without them every duration is as good as any.
    The visual metric counts only where there is a video.
    """
    c = fit.Calibration(idle_allowance=0.0, duration_median=stats and stats[0], duration_mad=stats and stats[1])
    contact = score.contact(c)
    z = K.robust_z(F.col("duration_s"), *stats) if stats else None
    duration = F.lit(1.0) if z is None else F.coalesce(K.gauss(z, c.tau_fast, c.tau_slow), F.lit(1.0))
    idle = K.ramp(F.col("idle_fraction"), 1.0, c.idle_allowance)
    grasp = F.exp(-F.greatest(F.lit(0), F.col("grasp_transitions") - c.grasp_nominal) / c.grasp_decay)
    retry = F.when(F.col("grasp_transitions").isNull() | (F.col("grasp_transitions") < 0), 1.0).when(F.col("grasp_incomplete"), 0.0).otherwise(grasp)
    judged = {
        "h_smoothness": F.coalesce(score.smoothness(c), F.lit(0.0)), "h_acceleration": F.coalesce(score.acceleration(c), F.lit(0.0)),
        "h_collision": F.when(F.col("self_collision_suspect"), F.least(contact, F.lit(0.2))).otherwise(contact),
        "h_runtime": 0.5 * duration + 0.3 * idle + 0.2 * retry,
    }
    parts = {k: F.when(F.col("degenerate"), 0.0).otherwise(v) for k, v in judged.items()} | {"h_visual": score.video(c)}
    d = measures.select("*", *[v.alias(k) for k, v in parts.items()])
    return d.withColumn("aggregate", weighted({k: F.col(k) for k in parts}, weights or dict.fromkeys(parts, 0.2)))

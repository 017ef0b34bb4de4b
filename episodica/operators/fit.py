"""Dataset-level fits: one aggregation over the valid episodes, kept as a small frozen document."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .selection import percentiles, small

#: Default ranges (worst, best) of the quantities that are ramped.
BRACKETS = {
    "ldlj_wrist": (-19.7, -17.0), "ldlj_arm": (-20.4, -17.5), "ldlj_body": (-21.4, -18.5), "acc_arm_rms": (5.4, 3.6), "acc_arm_p99": (21.1, 13.5), "acc_body_rms": (2.8, 1.3),
    "acc_body_p99": (9.0, 5.1), "acc_wrist_rms": (3.3, 2.0), "acc_wrist_p99": (12.1, 5.8), "video_contrast": (30.0, 60.0),
}


@dataclass(frozen=True)
class Calibration:
    brackets: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(BRACKETS))
    duration_median: float | None = None
    duration_mad: float | None = None
    tau_fast: float = 2.0
    tau_slow: float = 1.25
    grasp_nominal: int = 4
    grasp_decay: float = 2.0
    contact_rate_ref: float = 0.5
    idle_allowance: float = 0.25
    sharpness_intercept: float | None = None
    sharpness_slope: float | None = None
    sharpness_fallback: tuple[float, float] = (58.0, 110.0)
    sharpness_allowance_scale: float = 1.5
    sharpness_allowance_cap: float = 0.5
    n_episodes_fitted: int = 0

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Calibration:
        """Unknown keys are ignored."""
        known = {f.name for f in dataclasses.fields(cls)}
        d = {k: v for k, v in json.loads(text).items() if k in known}
        if "brackets" in d:
            d["brackets"] = {k: tuple(v) for k, v in d["brackets"].items()}
        if "sharpness_fallback" in d:
            d["sharpness_fallback"] = tuple(d["sharpness_fallback"])
        return cls(**d)


def sharpness_line(valid: DataFrame) -> tuple[float | None, float | None]:
    """Least squares of sharpness on arm speed: 5 pairs at least, and speeds that differ."""
    usable = F.col("video_sharpness").isNotNull() & F.col("arm_speed_rms").isNotNull() & F.coalesce(F.col("video_decodable"), F.lit(False))
    d = valid.where(usable)
    r = d.agg(F.count("*").alias("n"), F.stddev_pop("arm_speed_rms").alias("s"), F.expr("regr_slope(video_sharpness, arm_speed_rms)").alias("k"), F.expr("regr_intercept(video_sharpness, arm_speed_rms)").alias("c")).first()
    return (r["c"], r["k"]) if r["n"] >= 5 and (r["s"] or 0) >= 1e-9 else (None, None)


def residual(intercept: float | None, slope: float | None) -> Column:
    if slope is None:
        return F.lit(None).cast("double")
    return F.col("video_sharpness") - (F.lit(intercept) + F.lit(slope) * F.col("arm_speed_rms"))


def fit_calibration(measures: DataFrame, lo: float = 5.0, hi: float = 95.0, base: Calibration | None = None) -> Calibration:
    base, valid = base or Calibration(), measures.where("valid")
    keys = [k for k in BRACKETS if k in measures.columns]
    ps = (lo / 100, hi / 100)
    grasps = F.when(F.col("grasp_transitions") >= 2, F.col("grasp_transitions"))
    p, r = percentiles(valid, {"duration_s": (F.col("duration_s"), (0.5,)), **{k: (F.col(k), ps) for k in keys}}, n=F.count("*"), grasp=F.mode(grasps, True))
    md = p["duration_s"][0]
    if not r["n"]:
        return base
    brackets = dict(base.brackets)
    for k in keys:
        if r[f"n_{k}"] >= 3 and p[k][0] != p[k][1]:
            a, b = p[k]
            brackets[k] = (a, b) if BRACKETS[k][0] < BRACKETS[k][1] else (b, a)
    c, s = sharpness_line(valid)
    res = residual(c, s)
    p2, r2 = percentiles(valid, {"off": (F.abs(F.col("duration_s") - F.lit(md)), (0.5,)), "residual": (res, ps)})
    mad = p2["off"][0]
    if r2["n_residual"] >= 3 and p2["residual"][0] != p2["residual"][1]:
        brackets["video_sharpness_residual"] = tuple(p2["residual"])
    return dataclasses.replace(
        base, brackets=brackets, duration_median=md if md is not None else base.duration_median, duration_mad=mad * 1.4826 if mad is not None else base.duration_mad,
        grasp_nominal=r["grasp"] if r["grasp"] is not None else base.grasp_nominal, sharpness_intercept=c, sharpness_slope=s, n_episodes_fitted=r["n"],
    )


@dataclass(frozen=True)
class Criterion:
    quantity: str
    good: float
    bad: float
    weight: float
    family: str
    label: str
    unit: str = ""
    action: str = "reject"
    enabled: bool = True


#: Anchors in physical units; the first nine hold for any robot and camera.
CRITERIA = (
    Criterion("idle_fraction", 0.30, 0.75, 1.0, "timing", "idle fraction"),
    Criterion("grasp_excess", 0.0, 4.0, 0.7, "timing", "extra hand transitions"),
    Criterion("contact_rate_hz", 0.20, 1.50, 0.5, "contact", "contact event rate", "Hz", "review"),
    Criterion("max_base_tilt_deg", 8.0, 25.0, 0.8, "contact", "max base tilt", "deg"),
    Criterion("duration_ratio", 1.35, 2.50, 1.0, "timing", "duration vs nominal (long)"),
    Criterion("duration_ratio_short", 0.70, 0.35, 1.0, "timing", "duration vs nominal (short)"),
    Criterion("video_clipped_fraction", 0.005, 0.050, 0.8, "video", "clipped pixels"),
    Criterion("video_brightness_dev", 30.0, 90.0, 0.8, "video", "exposure deviation", "grey"),
    Criterion("video_interframe_diff", 3.0, 0.5, 0.6, "video", "inter-frame difference", "grey"),
    Criterion("ldlj_wrist", -19.2, -21.7, 1.0, "smoothness", "wrist smoothness (LDLJ)"),
    Criterion("ldlj_arm", -19.9, -22.4, 0.7, "smoothness", "arm smoothness (LDLJ)"),
    Criterion("ldlj_body", -20.9, -23.4, 0.5, "smoothness", "body smoothness (LDLJ)"),
    Criterion("acc_arm_rms", 5.4, 9.5, 1.0, "acceleration", "arm acceleration RMS", "rad/s2"),
    Criterion("acc_arm_p99", 21.0, 38.0, 1.0, "acceleration", "arm acceleration p99", "rad/s2"),
    Criterion("acc_body_rms", 2.8, 6.0, 0.7, "acceleration", "body acceleration RMS", "rad/s2"),
    Criterion("acc_body_p99", 9.0, 20.0, 0.7, "acceleration", "body acceleration p99", "rad/s2"),
    Criterion("acc_wrist_rms", 3.3, 7.0, 0.7, "acceleration", "wrist acceleration RMS", "m/s2"),
    Criterion("acc_wrist_p99", 12.0, 26.0, 0.7, "acceleration", "wrist acceleration p99", "m/s2"),
    Criterion("video_sharpness_residual", -18.0, -55.0, 0.8, "video", "sharpness (motion-corrected)", "lap.var"),
    Criterion("video_contrast", 45.0, 18.0, 0.6, "video", "contrast", "grey"),
)
FITTED = tuple(c.quantity for c in CRITERIA[9:])


@dataclass(frozen=True)
class Profile:
    criteria: tuple[Criterion, ...] = CRITERIA
    threshold: float = 0.50
    task_duration_s: float | None = None
    grasp_nominal: int = 4
    sharpness_intercept: float | None = None
    sharpness_slope: float | None = None
    fitted_on: str = ""
    n_episodes_fitted: int = 0
    notes: str = ""

    def to_json(self) -> str:
        return json.dumps(dataclasses.asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Profile:
        known = {f.name for f in dataclasses.fields(cls)}
        fields = {f.name for f in dataclasses.fields(Criterion)}
        d = {k: v for k, v in json.loads(text).items() if k in known}
        if "criteria" in d:
            d["criteria"] = tuple(Criterion(**{k: v for k, v in c.items() if k in fields}) for c in d["criteria"])
        return cls(**d)


def quantity(key: str, p: Profile) -> Column:
    """A criterion's quantity in its physical unit, NULL where it can't be measured."""
    if key == "grasp_excess":
        ok = (F.col("grasp_transitions") >= 0) & ~F.col("grasp_incomplete")
        return F.when(ok, F.greatest(F.lit(0), F.col("grasp_transitions") - p.grasp_nominal).cast("double"))
    if key in ("duration_ratio", "duration_ratio_short"):
        return F.col("duration_s") / p.task_duration_s if p.task_duration_s and p.task_duration_s > 0 else F.lit(None).cast("double")
    if key == "video_brightness_dev":
        return F.abs(F.col("video_brightness") - 127.5)
    if key == "video_sharpness_residual":
        return residual(p.sharpness_intercept, p.sharpness_slope)
    if key.startswith("video_"):
        return F.when(F.col("video_decodable"), F.col(key).cast("double"))
    return F.col(key).cast("double")


def unpivot(measures: DataFrame, p: Profile, criteria: tuple[Criterion, ...]) -> DataFrame:
    """A row per episode and criterion; a projection, with the anchors as constants."""
    active = [(i, c) for i, c in enumerate(criteria) if c.enabled]
    # values alone are spread and the rest is looked up by place: code that names every criterion in full is too long for the JVM to compile
    d = measures.select("episode", "valid", F.posexplode(F.array(*[quantity(c.quantity, p).cast("double") for _, c in active]).cast("array<double>")).alias("__at", "value"))
    of = lambda name, values: F.get(F.array(*[F.lit(v) for v in values]), F.col("__at")).alias(name) if active else F.lit(None).alias(name)
    texts = [of(k, [getattr(c, k) for _, c in active]) for k in ("quantity", "label", "family", "unit", "action")]
    numbers = [of(k, [float(getattr(c, k)) for _, c in active]) for k in ("weight", "good", "bad")]
    return d.select("episode", "valid", of("rank", [i for i, _ in active]), *texts, *numbers, "value")


def fit_profile(measures: DataFrame, base: Profile | None = None, good_sigma: float = 1.0, bad_sigma: float = 4.0, fitted_on: str = "") -> Profile:
    base, valid = base or Profile(), measures.where("valid")
    grasps = F.when(F.col("grasp_transitions") >= 2, F.col("grasp_transitions"))
    middle, r = percentiles(valid, {"duration_s": (F.col("duration_s"), (0.5,))}, n=F.count("*"), grasp=F.mode(grasps, True))
    p = dataclasses.replace(base, fitted_on=fitted_on)
    if not r["n"]:
        return p
    c, s = sharpness_line(valid)
    p = dataclasses.replace(
        p, task_duration_s=p.task_duration_s if p.task_duration_s is not None else middle["duration_s"][0], grasp_nominal=r["grasp"] if r["grasp"] is not None else p.grasp_nominal,
        sharpness_intercept=c if s is not None else p.sharpness_intercept, sharpness_slope=s if s is not None else p.sharpness_slope, n_episodes_fitted=r["n"],
    )
    fitted = tuple(x for x in p.criteria if x.quantity in FITTED)
    values = valid.select(*[quantity(x.quantity, p).alias(x.quantity) for x in fitted])
    m, n = percentiles(values, {x.quantity: (F.col(x.quantity), (0.5,)) for x in fitted})
    d, _ = percentiles(values, {k: (F.abs(F.col(k) - F.lit(v[0])), (0.5,)) for k, v in m.items()})
    out = []
    for x in p.criteria:
        if x.quantity in FITTED and n[f"n_{x.quantity}"] >= 5 and (sigma := d[x.quantity][0] * 1.4826) > 0:
            sign = 1 if x.bad > x.good else -1
            x = dataclasses.replace(x, good=round(m[x.quantity][0] + sign * good_sigma * sigma, 4), bad=round(m[x.quantity][0] + sign * bad_sigma * sigma, 4))
        out.append(x)
    return dataclasses.replace(p, criteria=tuple(out))


def refit_profile(measures: DataFrame, current: Profile | None = None, task_duration: float | None = None, good_sigma: float = 1.0, bad_sigma: float = 4.0, fitted_on: str = "") -> Profile:
    """Anchors from this batch; the threshold in force stays, since strictness is the user's choice."""
    p = fit_profile(measures, None, good_sigma, bad_sigma, fitted_on)
    p = dataclasses.replace(p, threshold=current.threshold if current else Profile().threshold)
    return p if task_duration is None else dataclasses.replace(p, task_duration_s=float(task_duration))


def drift(measures: DataFrame, p: Profile) -> DataFrame:
    """How a batch's valid episodes lie against a frozen profile."""
    from ..functions.kernels import position

    d = unpivot(measures, p, p.criteria).where("valid").withColumn("u", position(F.col("value"), F.col("good"), F.col("bad")))
    return d.groupBy("quantity", "label", "rank").agg(
        F.count("value").alias("n"), F.percentile("value", F.lit(0.5)).alias("median_value"), F.percentile("u", F.lit(0.5)).alias("median_u"),
        F.avg((F.col("u") > 0).cast("double")).alias("over_good"), F.avg((F.col("u") >= 1).cast("double")).alias("over_bad"),
    ).orderBy(F.desc_nulls_last("over_bad"), "rank").drop("rank")


#: Rule quantities with the side on which they get worse and the percentile that seeds a limit.
RULE_SEEDS = {
    "ldlj_wrist": ("<", 2), "ldlj_arm": ("<", 2), "ldlj_body": ("<", 2), "acc_arm_rms": (">", 98), "acc_arm_p99": (">", 98), "acc_body_rms": (">", 98), "acc_body_p99": (">", 98), "acc_wrist_rms": (">", 98),
    "acc_wrist_p99": (">", 98), "contact_rate_hz": (">", 98), "max_base_tilt_deg": (">", 98), "min_wrist_separation_m": ("<", 2), "duration_s": (">", 95), "duration_short_s": ("<", 2), "idle_fraction": (">", 98),
    "grasp_transitions": (">", 98), "eef_path_m": ("<", 2), "video_sharpness": ("<", 2), "video_clipped_fraction": (">", 98), "video_interframe_diff": ("<", 2),
}

#: What a rule quantity is called, and its unit.
RULE_TEXTS = {
    "ldlj_wrist": ("wrist smoothness (LDLJ)", ""), "ldlj_arm": ("arm smoothness (LDLJ)", ""), "ldlj_body": ("body smoothness (LDLJ)", ""),
    "acc_arm_rms": ("arm acceleration RMS", "rad/s²"), "acc_arm_p99": ("arm acceleration p99", "rad/s²"), "acc_body_rms": ("body acceleration RMS", "rad/s²"),
    "acc_body_p99": ("body acceleration p99", "rad/s²"), "acc_wrist_rms": ("wrist acceleration RMS", "m/s²"), "acc_wrist_p99": ("wrist acceleration p99", "m/s²"),
    "contact_rate_hz": ("contact event rate", "Hz"), "max_base_tilt_deg": ("max base tilt", "deg"), "min_wrist_separation_m": ("min wrist separation", "m"),
    "duration_s": ("duration (too long)", "s"), "duration_short_s": ("duration (too short)", "s"), "idle_fraction": ("idle fraction", ""), "grasp_transitions": ("hand transitions", ""),
    "eef_path_m": ("wrist path length", "m"), "video_sharpness": ("sharpness", "lap.var"), "video_clipped_fraction": ("clipped pixels", ""), "video_interframe_diff": ("inter-frame difference", "grey"),
}


def rule_value(key: str) -> Column:
    if key.startswith("video_"):
        return F.when(F.col("video_decodable"), F.col(key).cast("double"))
    return F.col("duration_s" if key == "duration_short_s" else key).cast("double")


def suggest_rules(measures: DataFrame, quantities: Sequence[str] | None = None, action: str | None = None) -> DataFrame:
    """quantity, op, limit: disabled rules seeded from percentiles of the valid episodes; with an action, that and what users read too."""
    chosen = {k: RULE_SEEDS[k] for k in (RULE_SEEDS if quantities is None else quantities)}
    if not chosen:
        chosen, measures = RULE_SEEDS, measures.limit(0)
    p, n = percentiles(measures.where("valid"), {k: (rule_value(k), (pct / 100,)) for k, (_, pct) in chosen.items()})
    got = [(k, op, p[k][0]) for k, (op, _) in chosen.items() if n[f"n_{k}"] >= 3]
    rules = small(measures.sparkSession, got, "quantity string, op string, limit double").select("quantity", "op", F.round("limit", 4).alias("limit"), F.lit(False).alias("enabled"))
    if action is None:
        return rules
    texts = F.create_map(*[F.lit(x) for k in chosen for x in (k, RULE_TEXTS[k][0])]), F.create_map(*[F.lit(x) for k in chosen for x in (k, RULE_TEXTS[k][1])])
    return rules.select("*", F.lit(action).alias("action"), texts[0][F.col("quantity")].alias("label"), texts[1][F.col("quantity")].alias("unit"))

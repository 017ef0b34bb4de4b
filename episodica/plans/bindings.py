"""Episode views over the given star-schema tables, and the same views as DuckDB SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

GROUPS = {"left_arm": (0, 2), "waist": (2, 4), "right_arm": (4, 5)}
STEP = 0.02


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames from events: an episode per user, in time order, at 50 Hz."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    k = F.get_json_object("props", "$.k").cast("double")
    d = e.select(
        F.col("user_id").alias("episode"), (F.row_number().over(w) - 1).cast("int").alias("frame_index"), "value", k.alias("k"),
        F.coalesce(F.lag("value").over(w), F.col("value")).alias("prev"), (F.length("event_type") / 10).alias("code"),
        (F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)") / 1e6).alias("t_real"),
    )
    v, i = F.col("value"), F.col("frame_index")
    state = [v / 100, F.col("k") / 100, (v - F.col("prev")) / 50, F.lit(1.0), F.col("code")]
    action = [s + 0.01 * (F.col("k") % 5) for s in state]
    left = [v / 500, F.col("k") / 100, i * 0.001]
    right = [v / 300, F.col("k") / 50, 0.3 + i * 0.002]
    zero = [F.lit(0.0)] * 4
    return d.select(
        "episode", "frame_index", (i * STEP).alias("t"), "t_real", "value", "k", "code", F.array(*state).alias("state"), F.array(*action).alias("action"), F.array(*left, *zero, *right, *zero).alias("eef"),
        F.array(F.col("k") / 500, (v - F.col("prev")) / 2000, v / 1000 - 1).alias("gravity"), F.lit(None).cast("array<double>").alias("left_hand"), F.array(*[v * 6] * 6).alias("right_hand"),
    )


FRAMES_SQL = """
ev as (select user_id as episode, (row_number() over w - 1)::int as frame_index, value, (props->>'k')::double as k, coalesce(lag(value) over w, value) as prev,
  length(event_type) / 10.0::double as code, (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 1e6::double as t_real from events window w as (partition by user_id order by ts, event_id)),
frames as (select *, frame_index * 0.02::double as t, value / 100 as s0, k / 100 as s1, (value - prev) / 50 as s2, 1.0::double as s3, code as s4,
  value / 500 as l0, k / 100 as l1, frame_index * 0.001::double as l2, value / 300 as r0, k / 50 as r1, 0.3::double + frame_index * 0.002::double as r2,
  k / 500 as g0, (value - prev) / 2000 as g1, value / 1000 - 1 as g2, value * 6 as closure from ev)"""


def gradient_sql(x: str, t: str = "t", w: str = "w") -> str:
    b, a, tb, ta = f"lag({x}) over {w}", f"lead({x}) over {w}", f"lag({t}) over {w}", f"lead({t}) over {w}"
    return (
        f"case when {tb} is null and {ta} is null then 0.0::double when {tb} is null then ({a} - {x}) / ({ta} - {t}) when {ta} is null then ({x} - {b}) / ({t} - {tb}) "
        f"else -({ta} - {t}) / (({t} - {tb}) * ({ta} - {tb})) * ({b}) + (({ta} - {t}) - ({t} - {tb})) / (({t} - {tb}) * ({ta} - {t})) * {x} + ({t} - {tb}) / (({ta} - {t}) * ({ta} - {tb})) * ({a}) end"
    )


_JW = "window w as (partition by episode, joint order by t, frame_index)"
SAMPLES_SQL = f"""
js as (select episode, frame_index, t, unnest([0, 1, 2, 3, 4]) as joint, unnest([s0, s1, s2, s3, s4]) as q, unnest([s0 + 0.01::double * (k % 5), s1 + 0.01::double * (k % 5), s2 + 0.01::double * (k % 5), s3 + 0.01::double * (k % 5), s4 + 0.01::double * (k % 5)]) as command from frames),
j1 as (select *, stddev_pop(q) over (partition by episode, joint) > 1e-6 as alive, {gradient_sql('q')} as v from js {_JW}),
j2 as (select *, {gradient_sql('v')} as a from j1 {_JW}),
samples as (select *, {gradient_sql('a')} as j, command - q - median(command - q) over (partition by episode, joint) as res from j2 {_JW}),
pf as (select episode, frame_index, t, sqrt(coalesce(sum(v * v) filter (alive), 0)) as speed,
  sqrt(sum(v * v) filter (alive and joint in (0, 1, 4))) as arm_speed, sum(j * j) filter (alive and joint in (0, 1, 4)) as arm_jerk2,
  sqrt(sum(v * v) filter (alive and joint in (2, 3))) as body_speed, sum(j * j) filter (alive and joint in (2, 3)) as body_jerk2,
  sqrt(sum(res * res) filter (alive and joint in (0, 1, 4))) as residual from samples group by all)"""

_EW = "window w as (partition by episode order by t, frame_index)"


def _grads(cols: list[str], src: str, out: str) -> str:
    return ", ".join(f"{gradient_sql(c + src)} as {c}{out}" for c in cols)


_P = ["l0", "l1", "l2", "r0", "r1", "r2", "g0", "g1", "g2"]
_N = lambda a, s="": f"sqrt({a}0{s} * {a}0{s} + {a}1{s} * {a}1{s} + {a}2{s} * {a}2{s})"
_STEPS = lambda a: "sqrt(" + " + ".join(f"({a}{k} - lag({a}{k}) over w) * ({a}{k} - lag({a}{k}) over w)" for k in range(3)) + ")"
WRIST_SQL = f"""
w1 as (select *, {_grads(_P, '', '_v')}, {_STEPS('l')} as left_step, {_STEPS('r')} as right_step from frames {_EW}),
w2 as (select *, {_grads(_P, '_v', '_a')}, sum(left_step) over (partition by episode) as left_path, sum(right_step) over (partition by episode) as right_path from w1 {_EW}),
w3 as (select *, {_grads(_P[:6], '_a', '_j')} from w2 {_EW}),
wrist as (select episode, frame_index, t, closure, side, left_path, right_path,
    case when side = 'left' then left_path else right_path end as wrist_path,
    case when side = 'left' then {_N('l', '_v')} else {_N('r', '_v')} end as wrist_speed,
    case when side = 'left' then {_N('l', '_a')} else {_N('r', '_a')} end as wrist_acc,
    case when side = 'left' then {_N('l', '_j')} else {_N('r', '_j')} end as wrist_jerk,
    sqrt((l0 - r0) * (l0 - r0) + (l1 - r1) * (l1 - r1) + (l2 - r2) * (l2 - r2)) as separation,
    degrees(acos(greatest(-1, least(1, -g2 / greatest({_N('g')}, 1e-9))))) as tilt, {_N('g', '_a')} as base_acc
  from (select *, case when left_path is null then 'right' when right_path > left_path then 'right' else 'left' end as side from w3))"""

_SPIKE = lambda c: f"(mad_{c} > 1e-12 and {c} > med_{c} + 6 * 1.4826 * mad_{c})"
_LDLJ = lambda c: (
    f"case when count({c}_speed) >= 4 and max(t) - min(t) > 0 and max({c}_speed) > 1e-9 and sum({c}_area) > 0 then -ln(pow(max(t) - min(t), 3) / (max({c}_speed) * max({c}_speed)) * sum({c}_area)) end as ldlj_{c}"
)
MEASURE_SQL = f"""
f1 as (select *, wrist_jerk * wrist_jerk as wrist_jerk2 from pf join wrist using (episode, frame_index, t)),
f2 as (select *, median(wrist_acc) over e as med_wrist_acc, median(base_acc) over e as med_base_acc, median(residual) over e as med_residual, quantile_cont(wrist_speed, 0.25) over e as p25,
  greatest(0.10, 0.05 * quantile_cont(speed, 0.95) over e) as idle_bar, {gradient_sql('wrist_speed')} as slope, count(*) over e as n, first_value(closure) over w as first_closure,
  t - lag(t) over w as step, (t - lag(t) over w) * (arm_jerk2 + lag(arm_jerk2) over w) / 2 as arm_area, (t - lag(t) over w) * (body_jerk2 + lag(body_jerk2) over w) / 2 as body_area,
  (t - lag(t) over w) * (wrist_jerk2 + lag(wrist_jerk2) over w) / 2 as wrist_area,
  last_value(case when closure > 360 then false when closure < 240 then true end ignore nulls) over (partition by episode order by t, frame_index rows unbounded preceding) as held
  from f1 window w as (partition by episode order by t, frame_index), e as (partition by episode)),
f3 as (select *, median(abs(wrist_acc - med_wrist_acc)) over e as mad_wrist_acc, median(abs(base_acc - med_base_acc)) over e as mad_base_acc, median(abs(residual - med_residual)) over e as mad_residual,
  coalesce(held, first_closure < 300) as closed from f2 window e as (partition by episode)),
f4 as (select *, coalesce({_SPIKE('wrist_acc')} and slope < 0 and wrist_speed > greatest(p25, 1e-3), false) as impact, coalesce({_SPIKE('base_acc')}, false) and n > 2 as base_vote,
  coalesce({_SPIKE('residual')}, false) as tracking_vote from f3),
f5 as (select *, impact::int + base_vote::int + tracking_vote::int >= 2 as confirmed, closed <> lag(closed) over w as switch from f4 {_EW}),
f6 as (select *, confirmed and not coalesce(lag(confirmed) over w, false) as starts, impact and not coalesce(lag(impact) over w, false) as impact_starts from f5 {_EW}),
acc as (select episode, sqrt(avg(a * a) filter (alive and joint in (0, 1, 4))) as acc_arm_rms, quantile_cont(abs(a), 0.99) filter (alive and joint in (0, 1, 4)) as acc_arm_p99,
  sqrt(avg(a * a) filter (alive and joint in (2, 3))) as acc_body_rms, quantile_cont(abs(a), 0.99) filter (alive and joint in (2, 3)) as acc_body_p99,
  sqrt(avg(v * v) filter (alive and joint in (0, 1, 4))) as arm_speed_rms, sqrt(avg(a * a) filter (alive and joint < 2)) as acc_left_arm_rms,
  sqrt(avg(a * a) filter (alive and joint in (2, 3))) as acc_waist_rms, sqrt(avg(a * a) filter (alive and joint = 4)) as acc_right_arm_rms from samples group by episode),
per as (select episode, count(*) as n_frames, max(t) - min(t) as duration_s, coalesce(1 / nullif(median(step), 0), 0) as fps, any_value(side) as side, any_value(wrist_path) as eef_path_m,
  {_LDLJ('arm')}, {_LDLJ('body')}, {_LDLJ('wrist')}, sqrt(avg(wrist_acc * wrist_acc)) as acc_wrist_rms, quantile_cont(wrist_acc, 0.99) as acc_wrist_p99,
  sum(starts::int)::bigint as contact_count, sum(impact_starts::int)::bigint as impact_count, coalesce(sum(starts::int) / nullif(max(t) - min(t), 0), 0) as contact_rate_hz,
  min(separation) as min_wrist_separation_m, max(tilt) as max_base_tilt_deg, avg((speed < idle_bar)::int) as idle_fraction, max(speed) as max_speed, coalesce(sum(switch::int), 0)::int as grasp_transitions
  from f6 group by episode),
measured as (select *, duration_s <= 0 or coalesce(eef_path_m < 0.30, max_speed < 1e-3) as degenerate, grasp_transitions between 0 and 1 as grasp_incomplete,
  coalesce(min_wrist_separation_m < 0.10, false) as self_collision_suspect from per left join acc using (episode))"""

ALL_SQL = f"with {FRAMES_SQL},{SAMPLES_SQL},{WRIST_SQL},{MEASURE_SQL}\n"

#: One row per order: quantities in their usual ranges from integers, so that any engine gets the same doubles.
MEASURES = {
    "ldlj_wrist": "-16.0 - (e * 7 % 61) / 10.0", "ldlj_arm": "-17.0 - (e * 11 % 59) / 10.0", "ldlj_body": "-18.0 - nullif(e * 13 % 57, 3) / 10.0",
    "acc_arm_rms": "3.0 + (q * 3 % 67) / 10.0", "acc_arm_p99": "12.0 + (q * 5 % 271) / 10.0", "acc_body_rms": "1.0 + (e * 3 % 53) / 10.0", "acc_body_p99": "4.0 + (q * 7 % 171) / 10.0",
    "acc_wrist_rms": "1.8 + (e * 5 % 59) / 10.0", "acc_wrist_p99": "5.0 + nullif(q % 223, 7) / 10.0", "arm_speed_rms": "0.2 + (e % 23) / 20.0",
    "contact_rate_hz": "(q % 31) / 20.0", "max_base_tilt_deg": "2.0 + (e * 17 % 240) / 10.0", "min_wrist_separation_m": "0.05 + (q * 11 % 97) / 100.0", "duration_s": "10.0 + n * 2.0 + (e % 13) / 10.0",
    "idle_fraction": "(e * 19 % 81) / 100.0", "grasp_transitions": "e % 11 - 1", "eef_path_m": "0.2 + (q * 13 % 301) / 100.0",
    "video_sharpness": "50.0 + (e * 23 % 89) - (e % 23) / 4.0", "video_contrast": "15.0 + (q * 17 % 51)", "video_clipped_fraction": "(e * 29 % 61) / 1000.0", "video_brightness": "40.0 + (q * 19 % 181)", "video_interframe_diff": "0.4 + (e * 31 % 37) / 10.0",
    "video_decode_ratio": "case when e % 43 = 5 then 0.9 else 1.0 end",
}
_BOOL = {"video_decodable": "e % 41 <> 7"}


def _doubles(sql: str) -> str:
    """Spark's text of an expression: its literals with a point are doubles, as DuckDB's quotients are, not decimals."""
    return re.sub(r"\d+\.\d+", r"\g<0>D", sql)


def _typed(name: str, sql: str) -> str:
    return f"cast({sql} as {'int' if name == 'grasp_transitions' else 'double'}) as {name}"


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure-like rows with flags, an episode per order."""
    from ..operators.measure import flag

    li = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("q"), F.count("*").alias("n"))
    d = li.select(F.col("l_orderkey").alias("e"), "q", "n").selectExpr("e as episode", *[_typed(k, _doubles(v)) for k, v in MEASURES.items()], *[f"{v} as {k}" for k, v in _BOOL.items()], "case e % 9 when 0 then 0.0D when 1 then 0.5D when 2 then null else 1.0D end as semantic", "0.0D as max_speed")
    return flag(d).drop("max_speed")


MEASURES_SQL = (
    "raw as (select l_orderkey as e, sum(l_quantity)::bigint as q, count(*) as n from lineitem group by l_orderkey), m0 as (select e as episode, "
    + ", ".join(_typed(k, v) for k, v in MEASURES.items())
    + ", "
    + ", ".join(f"{v} as {k}" for k, v in _BOOL.items())
    + ", case e % 9 when 0 then 0.0 when 1 then 0.5 when 2 then null else 1.0 end::double as semantic from raw), "
    "m1 as (select *, duration_s <= 0 or eef_path_m < 0.30 as degenerate, grasp_transitions between 0 and 1 as grasp_incomplete, not video_decodable as video_unreadable, "
    "video_decodable and video_decode_ratio < 0.95 as video_truncated, min_wrist_separation_m < 0.10 as self_collision_suspect, video_decodable and video_interframe_diff < 1.0 as video_frozen from m0), "
    "m as (select *, not (degenerate or grasp_incomplete or video_unreadable or video_truncated) as valid, self_collision_suspect or video_frozen as needs_review from m1)"
)

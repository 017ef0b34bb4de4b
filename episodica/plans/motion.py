"""Queries over frames: the kernels and the measurement families."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import kernels as K
from ..operators import measure as M
from . import bindings as B

QUERIES: dict = {}
SQL: dict[str, str] = {}
DIGITS = 6


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put


def rounded(df, *keep):
    """Doubles rounded, so that engines that add in another order agree."""
    return df.select(*[F.round(c, DIGITS).alias(c) if t == "double" and c not in keep else F.col(c) for c, t in df.dtypes])


def _samples(spark, sf_dir):
    return M.joint_samples(B.frames(spark, sf_dir))


def _sql(ctes: str, select: str) -> str:
    return f"with {ctes}\n{select}"


_FS = f"{B.FRAMES_SQL},{B.SAMPLES_SQL}"


@query("gradient_regular", _sql(_FS, "select episode, frame_index, joint, round(v, 6) as v from samples"))
def gradient_regular(spark, sf_dir):
    return rounded(_samples(spark, sf_dir).select("episode", "frame_index", "joint", "v"))


@query("acceleration", _sql(_FS, "select episode, frame_index, joint, round(a, 4) + 0.0 as a from samples"))
def acceleration(spark, sf_dir):
    return _samples(spark, sf_dir).select("episode", "frame_index", "joint", (F.round("a", 4) + 0.0).alias("a"))


@query("jerk", _sql(_FS, "select episode, frame_index, joint, round(j, 2) + 0.0 as j from samples"))
def jerk(spark, sf_dir):
    return _samples(spark, sf_dir).select("episode", "frame_index", "joint", (F.round("j", 2) + 0.0).alias("j"))


@query("gradient_irregular", _sql(B.FRAMES_SQL, f"select episode, frame_index, round({B.gradient_sql('value', 't_real')}, 6) as g from frames window w as (partition by episode order by t_real, frame_index)"))
def gradient_irregular(spark, sf_dir):
    w = W.partitionBy("episode").orderBy("t_real", "frame_index")
    return B.frames(spark, sf_dir).select("episode", "frame_index", F.round(K.gradient(F.col("value"), F.col("t_real"), w), 6).alias("g"))


@query("timing_stats", _sql(B.FRAMES_SQL, "select episode, count(*) as n_frames, round(median(d), 6) as dt, round(max(t) - min(t), 6) as duration_s, round(1 / median(d), 6) as fps from (select *, t - lag(t) over (partition by episode order by t) as d from frames) group by episode"))
def timing_stats(spark, sf_dir):
    d = B.frames(spark, sf_dir).withColumn("d", F.col("t") - F.lag("t").over(M.by_t()))
    return rounded(d.groupBy("episode").agg(F.count("*").alias("n_frames"), F.median("d").alias("dt"), (F.max("t") - F.min("t")).alias("duration_s"), F.try_divide(F.lit(1.0), F.median("d")).alias("fps")))


@query("active_mask", _sql(_FS, "select episode, joint, bool_or(alive) as alive from samples group by episode, joint"))
def active_mask(spark, sf_dir):
    return _samples(spark, sf_dir).groupBy("episode", "joint").agg(F.max("alive").alias("alive"))


@query("joint_select", _sql(_FS + ", g(name, lo, hi) as (values ('left_arm', 0, 2), ('waist', 2, 4), ('right_arm', 4, 5))", "select distinct episode, name as group_name, joint from samples join g on joint >= lo and joint < hi where alive"))
def joint_select(spark, sf_dir):
    groups = spark.createDataFrame([(n, a, b) for n, (a, b) in B.GROUPS.items()], "group_name string, a int, b int")
    alive = _samples(spark, sf_dir).where("alive").select("episode", "joint").distinct()
    return alive.join(F.broadcast(groups), (F.col("joint") >= F.col("a")) & (F.col("joint") < F.col("b"))).select("episode", "group_name", "joint")


@query("joint_speed", _sql(_FS, "select episode, frame_index, round(speed, 6) as speed from pf"))
def joint_speed(spark, sf_dir):
    return rounded(M.per_frame(_samples(spark, sf_dir), B.GROUPS).select("episode", "frame_index", "speed"))


_FW = f"{B.FRAMES_SQL},{B.WRIST_SQL}"


@query("path_and_side", _sql(_FW, "select episode, any_value(side) as side, round(any_value(wrist_path), 6) as path from wrist group by episode"))
def path_and_side(spark, sf_dir):
    return M.wrist_frames(B.frames(spark, sf_dir)).groupBy("episode").agg(F.first("side").alias("side"), F.round(F.first("wrist_path"), 6).alias("path"))


@query("working_hand", _sql(_FW, "select episode, frame_index, round(closure, 6) as closure from wrist"))
def working_hand(spark, sf_dir):
    return rounded(M.wrist_frames(B.frames(spark, sf_dir)).select("episode", "frame_index", "closure"))


@query("robust_spikes", _sql(B.FRAMES_SQL, "select episode, frame_index, coalesce(mad > 1e-12 and x > med + 6 * 1.4826 * mad, false) as spike from (select *, median(abs(x - med)) over (partition by episode) as mad from (select *, value * value as x, median(value * value) over (partition by episode) as med from frames))"))
def robust_spikes(spark, sf_dir):
    return B.frames(spark, sf_dir).select("episode", "frame_index", K.spikes(F.col("value") * F.col("value"), M.ep()).alias("spike"))


@query("event_runs", _sql(B.FRAMES_SQL, "select episode, sum((b and not coalesce(pb, false))::int)::bigint as n_runs from (select episode, value > 100 as b, lag(value > 100) over (partition by episode order by t) as pb from frames) group by episode"))
def event_runs(spark, sf_dir):
    d = B.frames(spark, sf_dir).withColumn("s", K.run_starts(F.col("value") > 100, M.by_t()))
    return d.groupBy("episode").agg(F.sum(F.col("s").cast("int")).alias("n_runs"))


@query("hysteresis", _sql(B.FRAMES_SQL, "select episode, frame_index, coalesce(last_value(case when value > 70 then false when value < 30 then true end ignore nulls) over (partition by episode order by t rows unbounded preceding), first_value(value) over (partition by episode order by t) < 50, false) as closed from frames"))
def hysteresis(spark, sf_dir):
    return B.frames(spark, sf_dir).select("episode", "frame_index", K.hysteresis(F.col("value"), M.by_t(), 50, 20).alias("closed"))


@query("rms_p99", _sql(B.FRAMES_SQL, "select episode, round(sqrt(avg(value * value)), 6) as rms, round(quantile_cont(abs(value), 0.99), 6) as p99 from frames group by episode"))
def rms_p99(spark, sf_dir):
    return rounded(B.frames(spark, sf_dir).groupBy("episode").agg(K.rms(F.col("value")).alias("rms"), F.percentile(F.abs("value"), F.lit(0.99)).alias("p99")))


def _measured(spark, sf_dir):
    return M.measure(B.frames(spark, sf_dir), B.GROUPS)


def _family(name: str, cols: list[str], digits: int = 4):
    doubles = [c for c in cols if c not in ("side", "n_frames", "contact_count", "impact_count", "grasp_transitions", *M.HARD, *M.SOFT)]
    sql = B.ALL_SQL + "select episode, " + ", ".join(f"round({c}, {digits}) as {c}" if c in doubles else c for c in cols) + " from measured"

    @query(name, sql)
    def run(spark, sf_dir):
        return _measured(spark, sf_dir).select("episode", *[F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in cols])

    return run


_family("measure_smoothness", ["ldlj_arm", "ldlj_body", "ldlj_wrist"])
_family("measure_acceleration", ["acc_arm_rms", "acc_arm_p99", "acc_body_rms", "acc_body_p99", "acc_wrist_rms", "acc_wrist_p99", "arm_speed_rms", "acc_left_arm_rms", "acc_waist_rms", "acc_right_arm_rms"])
_family("measure_contact", ["contact_count", "impact_count", "contact_rate_hz", "min_wrist_separation_m", "max_base_tilt_deg"])
_family("measure_timing", ["n_frames", "duration_s", "fps", "idle_fraction", "grasp_transitions"])
_family("measure_flags", ["degenerate", "grasp_incomplete", "self_collision_suspect"])
_family("measure_episode", ["side", "eef_path_m", "max_speed", "duration_s", "ldlj_arm", "acc_arm_rms", "contact_rate_hz", "idle_fraction", "grasp_transitions", "degenerate"])

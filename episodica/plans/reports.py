"""Queries over series, scored episodes, exports and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import series as Z
from ..operators import inject as I
from ..operators import legacy as L
from ..operators import measure as M
from ..operators import report as R
from ..operators import score as S
from ..operators.selection import percentiles, small
from ..sources import datasets as D
from . import bindings as B
from .motion import rounded
from .scoring import ABS, CAL, PROFILE, RULES, WITH, _scored, m
from .scoring import _HEAD as HEAD
from .scoring import _TAIL as TAIL

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put


def _points(spark, sf_dir):
    return B.frames(spark, sf_dir).select("episode", F.col("frame_index").alias("i"), "t", F.col("value").alias("y"))


@query("decimate", f"with {B.FRAMES_SQL}, n as (select episode, frame_index as i, t, value as y, count(*) over (partition by episode) as n from frames), ed as (select distinct episode, n, b, (n * b) // 10 as lo, (n * (b + 1)) // 10 as hi from n, range(10) r(b)), x as (select n.*, b from n join ed on n.episode = ed.episode and i >= lo and i < hi), k as (select *, first_value(i) over (partition by episode, b order by y, i) as a, first_value(i) over (partition by episode, b order by y desc, i) as z from x) select episode, i, round(t, 4) as t, round(y, 5) as y from k where i = a or i = z")
def decimate(spark, sf_dir):
    return Z.decimate(_points(spark, sf_dir), 20)


@query("spans", f"with {B.FRAMES_SQL}, d as (select episode, t, value > 100 as mask, median(t - p) over (partition by episode) as dt, sum((not (value > 100))::int) over (partition by episode order by t rows unbounded preceding) as run from (select *, lag(t) over (partition by episode order by t) as p from frames)) select episode, round(min(t), 4) as start, round(max(t) + any_value(dt), 4) as stop from d where mask group by episode, run")
def spans(spark, sf_dir):
    return Z.spans(B.frames(spark, sf_dir).select("episode", "t", (F.col("value") > 100).alias("mask")))


@query("timebase", f"with {B.FRAMES_SQL} select episode, frame_index, round(case when episode % 2 = 0 then frame_index / 50.0 else t_real - min(t_real) over (partition by episode) end, 6) as s from frames")
def timebase(spark, sf_dir):
    d = B.frames(spark, sf_dir).withColumn("t0", F.min("t_real").over(M.ep())).withColumn("u", F.when(F.col("episode") % 2 != 0, F.col("t_real")))
    return rounded(d.select("episode", "frame_index", Z.time_base(F.col("u"), F.col("frame_index"), F.lit(0.0), F.col("t0")).alias("s")))


@query("asof_sample", f"with {B.FRAMES_SQL} select episode, coalesce(arg_min(value, t) filter (t >= 1.1), arg_max(value, t)) as y from frames group by episode")
def asof_sample(spark, sf_dir):
    return Z.sample_at(B.frames(spark, sf_dir).withColumnRenamed("value", "y"), F.lit(1.1))


def _decided(spark, sf_dir):
    return S.decide(S.score(m(spark, sf_dir), CAL), S.Policy(mode="weighted"))


_DEC = _scored() + ", dec as (" + HEAD.replace("select episode,", "select *,") + "when total < 0.35 then 'reject' " + TAIL + ")"


@query("overview_counts", _DEC + ", f as (select unnest([case when degenerate then 'degenerate' end, case when grasp_incomplete then 'grasp_incomplete' end, case when video_unreadable then 'video_unreadable' end, case when video_truncated then 'video_truncated' end, case when self_collision_suspect then 'self_collision_suspect' end, case when video_frozen then 'video_frozen' end]) as name from dec) select 'decision' as kind, decision as name, count(*) as n from dec group by all union all select 'flag', name, count(*) from f where name is not null group by all")
def overview_counts(spark, sf_dir):
    return R.counts(_decided(spark, sf_dir))


_FAMS = ["smoothness", "acceleration", "contact", "timing", "video", "total"]


@query("overview_families", _DEC + f", u as (unpivot (select {', '.join(_FAMS)} from dec) on {', '.join(_FAMS)} into name name value v) select name, count(v) as n, round(avg(v), 6) as mean, round(quantile_cont(v, 0.05), 6) + 0.0 as p5, round(quantile_cont(v, 0.5), 6) + 0.0 as p50, round(quantile_cont(v, 0.95), 6) + 0.0 as p95 from u group by name")
def overview_families(spark, sf_dir):
    d = rounded(R.distributions(_decided(spark, sf_dir), _FAMS))
    return d.select("name", "n", "mean", *[(F.col(c) + 0.0).alias(c) for c in ("p5", "p50", "p95")])


@query("severity_histogram", _scored() + ", t as (select greatest(quantile_cont(severity, 0.99), 1) as top from scored), b as (select least(floor(greatest(0, least(severity / top, 1)) * 20), 19)::int as bin from scored, t) select r.bin::int as bin, count(b.bin) as n from range(20) r(bin) left join b on b.bin = r.bin group by r.bin")
def severity_histogram(spark, sf_dir):
    return R.severity_histogram(S.score(m(spark, sf_dir), CAL))


@query("episode_rows", _DEC + " select episode, decision, round(total, 6) as total, round(smoothness, 6) as smoothness, round(video, 6) + 0.0 as video, semantic from dec")
def episode_rows(spark, sf_dir):
    d = rounded(_decided(spark, sf_dir).select("episode", "decision", "total", "smoothness", "video", "semantic"))
    return d.withColumn("video", F.col("video") + 0.0)


@query("agreement", _DEC + ", x as (select decision, l.doc_id is not null as o from dec left join (select distinct doc_id from labels where quality = 0) l on l.doc_id = dec.episode) select count(*) filter (o and decision = 'reject') as both, count(*) filter (o and decision <> 'reject') as missed, count(*) filter (not o and decision = 'reject') as extra, count(*) filter (not o and decision <> 'reject') as neither, count(*) filter (o and decision = 'review') as reviewed from x")
def agreement(spark, sf_dir):
    out = B.table(spark, sf_dir, "labels").where("quality = 0").select(F.col("doc_id").alias("episode"))
    return R.agreement(_decided(spark, sf_dir), out)


_RULE = {"acc_arm_rms": ("acc_arm_rms", ">", 9.0), "ldlj_wrist": ("ldlj_wrist", "<", -21.5), "idle_fraction": ("idle_fraction", ">", 0.6), "video_sharpness": ("case when video_decodable then video_sharpness end", "<", 60.0)}


@query("rule_report", WITH + ", r as (" + " union all ".join(f"select '{k}' as quantity, '{op}' as op, {lim}::double as \"limit\", ({v})::double as v from m where valid" for k, (v, op, lim) in _RULE.items()) + ") select quantity, op, \"limit\", count(*) filter (case op when '>' then v > \"limit\" else v < \"limit\" end) as hits, round(quantile_cont(v, 0.05), 6) as p5, round(quantile_cont(v, 0.5), 6) as p50, round(quantile_cont(v, 0.95), 6) as p95, round(min(v), 6) as least, round(max(v), 6) as most from r group by all")
def rule_report(spark, sf_dir):
    return rounded(R.rule_report(m(spark, sf_dir), RULES))


@query("criteria_rows", ABS + " select quantity, round(value, 6) + 0.0 as value, round(p, 6) as p, row_number() over (order by round(weight * cost, 9) desc nulls last, rank)::int as place from pen where episode = (select min(episode) from m)")
def criteria_rows(spark, sf_dir):
    d = m(spark, sf_dir)
    first = d.agg(F.min("episode").alias("episode"))
    rows = S.ranked(d.join(F.broadcast(first), "episode", "left_semi"), PROFILE)
    return rows.select("quantity", (F.round("value", 6) + 0.0).alias("value"), F.round("p", 6).alias("p"), "place")


@query("criteria_rows_all", ABS + " select episode, quantity, round(value, 6) + 0.0 as value, round(p, 6) as p, row_number() over (partition by episode order by round(weight * cost, 9) desc nulls last, rank)::int as place from pen")
def criteria_rows_all(spark, sf_dir):
    rows = S.ranked(m(spark, sf_dir), PROFILE)
    return rows.select("episode", "quantity", (F.round("value", 6) + 0.0).alias("value"), F.round("p", 6).alias("p"), "place")


@query("neighbours", WITH + " select episode, lag(episode) over (order by episode) as previous, lead(episode) over (order by episode) as next from m")
def neighbours(spark, sf_dir):
    return R.neighbours(m(spark, sf_dir))


@query("table_filter", _DEC + " select episode, decision, round(total, 6) as total from dec where decision in ('reject', 'review') and contains(lower(concat_ws(' ', episode::varchar, decision)), '17')")
def table_filter(spark, sf_dir):
    return rounded(R.search(_decided(spark, sf_dir), "17", ("reject", "review"), order="total").select("episode", "decision", "total"))


@query("what_if", _scored() + ", c(cut) as (values (0.2::double), (0.35), (0.5), (0.8)) select cut, count(*) filter (total < cut) as n from scored, c group by cut")
def what_if(spark, sf_dir):
    return R.what_if(S.score(m(spark, sf_dir), CAL), "total", (0.2, 0.35, 0.5, 0.8))


@query("quantiles", "with c as (select l_orderkey as episode, l_returnflag as camera, sum(l_quantity)::double as q from lineitem group by all), e as (select episode, avg(q) as mean from c group by episode), k as (select quantile_cont(mean, 0.25) as a, quantile_cont(mean, 0.5) as b, quantile_cont(mean, 0.75) as d from e) select c.episode, camera, ((mean > a)::int + (mean > b)::int + (mean > d)::int)::int as quantile from c join e using (episode), k")
def quantiles(spark, sf_dir):
    c = B.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode"), F.col("l_returnflag").alias("camera")).agg(F.sum("l_quantity").cast("double").alias("q"))
    return R.quantiles(c, "q").select("episode", "camera", "quantile")


_CC = ["ldlj_wrist", "acc_arm_rms", "idle_fraction", "ldlj_body"]


@query("correlation", WITH + " " + " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from m" for i, a in enumerate(_CC) for b in _CC[i:]))
def correlation(spark, sf_dir):
    return rounded(R.correlations(m(spark, sf_dir), _CC))


@query("orphans", "select c_custkey as episode from customer where c_custkey not in (select o_custkey from orders)")
def orphans(spark, sf_dir):
    return R.orphans(B.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("episode")), B.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("episode")))


@query("describe", WITH + ", u as (unpivot (select duration_s, ldlj_body from m) on duration_s, ldlj_body into name name value v) select name, count(v) as count, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std, round(min(v), 6) as min, round(quantile_cont(v, 0.25), 6) as q25, round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75, round(max(v), 6) as max from u group by name")
def describe(spark, sf_dir):
    return rounded(R.describe(m(spark, sf_dir), ["duration_s", "ldlj_body"]))


@query("report_percentiles", _scored() + " select round(quantile_cont(total, 0.1), 6) as p10, round(quantile_cont(total, 0.25), 6) as p25, round(quantile_cont(total, 0.5), 6) as p50, round(quantile_cont(total, 0.75), 6) as p75, round(quantile_cont(total, 0.9), 6) as p90, round(avg((total < 0.35)::int), 6) as below from scored")
def report_percentiles(spark, sf_dir):
    return rounded(R.thresholds(S.score(m(spark, sf_dir), CAL), "total", 0.35))


@query("worst_ten", _scored() + " select episode, round(severity, 6) as severity from scored order by round(severity, 9) desc, episode limit 10")
def worst_ten(spark, sf_dir):
    return rounded(R.worst(S.score(m(spark, sf_dir), CAL).withColumn("severity", F.round("severity", 9)), 10).select("episode", "severity"))


@query("selection", WITH + " select episode, duration_s from m where episode in (3, 17, 33)")
def selection(spark, sf_dir):
    return R.select_episodes(m(spark, sf_dir), "3,17,33").select("episode", "duration_s")


@query("vs_median", WITH + ", d as (select median(duration_s) as a, median(idle_fraction) as b from m where valid) select episode, round(duration_s - a, 6) + 0.0 as duration_s, round(idle_fraction - b, 6) + 0.0 as idle_fraction from m, d")
def vs_median(spark, sf_dir):
    d = rounded(R.against_median(m(spark, sf_dir), ["duration_s", "idle_fraction"]))
    return d.select("episode", (F.col("duration_s") + 0.0).alias("duration_s"), (F.col("idle_fraction") + 0.0).alias("idle_fraction"))


@query("criteria_spread", _scored() + " select episode, round(list_max(l) - list_min(l), 6) + 0.0 as spread, round(list_avg(l), 6) as mean from (select episode, list_filter([smoothness, acceleration, timing, video], lambda x: x is not null) as l from scored)")
def criteria_spread(spark, sf_dir):
    return rounded(R.spread(S.score(m(spark, sf_dir), CAL), ["smoothness", "acceleration", "timing", "video"])).withColumn("spread", F.col("spread") + 0.0)


@query("export_join", _DEC + " select m.episode, m.duration_s, dec.duration_s as duration_s_score, decision from m left join dec using (episode)")
def export_join(spark, sf_dir):
    return R.export_join(m(spark, sf_dir).select("episode", "duration_s"), _decided(spark, sf_dir).select("episode", "duration_s", "decision"))


@query("export_json", _DEC + " select list(episode order by episode) as episodes, ['accept', 'review'] as decisions from dec where decision in ('accept', 'review')")
def export_json(spark, sf_dir):
    return R.export_selection(_decided(spark, sf_dir), ["accept", "review"])


def _good(spark, sf_dir):
    return B.frames(spark, sf_dir).select("episode").distinct().where("episode % 3 <> 0")


@query("reindex_frames", f"with {B.FRAMES_SQL}, i as (select episode, row_number() over (order by episode) - 1 as episode_index, sum(count(*)) over (order by episode) - count(*) as o from frames where episode % 3 <> 0 group by episode) select (episode_index)::bigint as episode_index, frame_index::bigint as frame_index, (o + frame_index)::bigint as index, value from frames join i using (episode)")
def reindex_frames(spark, sf_dir):
    d = R.reindex(B.frames(spark, sf_dir).select("episode", "frame_index", "t", "value"), _good(spark, sf_dir))
    return d.select(F.col("episode_index").cast("long").alias("episode_index"), "frame_index", "index", "value")


@query("reindex_meta", f"with {B.FRAMES_SQL} select (row_number() over (order by episode) - 1)::bigint as episode, count(*) as length from frames where episode % 3 <> 0 group by frames.episode")
def reindex_meta(spark, sf_dir):
    meta = B.frames(spark, sf_dir).groupBy("episode").agg(F.count("*").alias("length"))
    return R.reindex_meta(meta, _good(spark, sf_dir))


@query("rebuild_splits", f"with {B.FRAMES_SQL}, g as (select episode, row_number() over (order by episode) - 1 as i from (select distinct episode from frames where episode % 3 <> 0)), s(name, a, b) as (values ('train', 0, 40), ('val', 40, 60)) select name, coalesce(least(b, min(i)), b) || ':' || coalesce(greatest(a, max(i)), a) as range from s left join g on episode between a and b group by name, a, b")
def rebuild_splits(spark, sf_dir):
    splits = spark.sql("select * from values ('train', 0, 40), ('val', 40, 60) as t(name, start, stop)")
    return R.rebuild_splits(splits, _good(spark, sf_dir))


_KEPT = f"{_scored()}, {B.FRAMES_SQL}, ruled as ({HEAD} when acc_arm_rms > 9.0 or ldlj_wrist < -21.5 then 'reject' when idle_fraction > 0.6 or (video_decodable and video_sharpness < 60) then 'review' {TAIL}), good as (select distinct episode from frames semi join (select episode from ruled where decision <> 'reject') using (episode))"


def _kept(spark, sf_dir):
    """Episodes with frames that the rules do not reject."""
    d = S.decide(S.score(m(spark, sf_dir), CAL), S.Policy(mode="rules", rules=RULES)).where("decision <> 'reject'").select("episode")
    return B.frames(spark, sf_dir).select("episode").distinct().join(d, "episode", "left_semi")


@query("reindex_frames_decided", _KEPT + ", i as (select episode, row_number() over (order by episode) - 1 as episode_index, sum(count(*)) over (order by episode) - count(*) as o from frames join good using (episode) group by episode) select (episode_index)::bigint as episode_index, frame_index::bigint as frame_index, (o + frame_index)::bigint as index, value from frames join i using (episode)")
def reindex_frames_decided(spark, sf_dir):
    d = R.reindex(B.frames(spark, sf_dir).select("episode", "frame_index", "t", "value"), _kept(spark, sf_dir))
    return d.select(F.col("episode_index").cast("long").alias("episode_index"), "frame_index", "index", "value")


@query("reindex_meta_decided", _KEPT + " select (row_number() over (order by episode) - 1)::bigint as episode, count(*) as length from frames join good using (episode) group by episode")
def reindex_meta_decided(spark, sf_dir):
    meta = B.frames(spark, sf_dir).groupBy("episode").agg(F.count("*").alias("length"))
    return R.reindex_meta(meta, _kept(spark, sf_dir))


@query("rebuild_splits_decided", _KEPT + ", g as (select episode, row_number() over (order by episode) - 1 as i from good), s(name, a, b) as (values ('train', 0, 40), ('val', 40, 60)) select name, least(b, coalesce(min(i), b)) || ':' || greatest(a, coalesce(max(i), a)) as range from s left join g on episode between a and b group by name, a, b")
def rebuild_splits_decided(spark, sf_dir):
    splits = spark.sql("select * from values ('train', 0, 40), ('val', 40, 60) as t(name, start, stop)")
    return R.rebuild_splits(splits, _kept(spark, sf_dir))


@query("chains", "select n_name as group_name, regexp_matches(lower(n_name), 'arm|shoulder|elbow|wrist') as arm, regexp_matches(lower(n_name), 'leg|waist|torso|hip|knee|ankle|spine') as body from nation")
def chains(spark, sf_dir):
    name = F.col("n_name")
    return B.table(spark, sf_dir, "nation").select(name.alias("group_name"), *[c.alias(k) for k, c in M.chains(name).items()])


@query("resolve_task", "select o_orderkey as episode, coalesce(r_name, 'AFRICA') as task from orders left join region on r_regionkey = o_orderkey % 7")
def resolve_task(spark, sf_dir):
    tasks = B.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("task_index"), F.col("r_name").alias("task"))
    rows = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode"), (F.col("o_orderkey") % 7).cast("int").alias("task_index"))
    return D.resolve_tasks(rows, tasks, default="AFRICA").select("episode", "task")


@query("manifest", "select event_id as line, case when event_id % 2 = 0 then 'a' || event_id else 'b' || event_id end as video, event_type as task from events where event_id % 5 <> 0")
def manifest(spark, sf_dir):
    e = B.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("line"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("a"), F.col("event_id"))).alias("video"), F.concat(F.lit("b"), F.col("event_id")).alias("path"), F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("task")
    )
    return D.check_manifest(e)[0]


@query("video_segments", "select o_orderkey as episode, 'videos/cam/chunk-' || lpad((o_orderkey % 3)::varchar, 3, '0') || '/file-' || lpad((o_orderkey % 10)::varchar, 3, '0') || '.mp4' as path, o_orderkey % 10 * 2.0::double as from_s, case when o_orderkey % 4 = 0 then 30.0 else o_orderkey % 10 * 2.0 + 5 end::double as to_s from orders")
def video_segments(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = B.table(spark, sf_dir, "orders").select(k.alias("episode_index"), (k % 3).alias("videos/cam/chunk_index"), (k % 10).alias("videos/cam/file_index"), (k % 10 * 2.0).alias("videos/cam/from_timestamp"), F.when(k % 4 != 0, k % 10 * 2.0 + 5).alias("videos/cam/to_timestamp"))
    return D.video_segments(rows, "cam", duration=F.lit(30.0)).select(F.col("episode_index").alias("episode"), "path", "from_s", "to_s")


@query("inject_motion_noise")
def inject_motion_noise(spark, sf_dir):
    d = M.joint_samples(B.frames(spark, sf_dir)).select("episode", "frame_index", "joint", "q", "command")
    return I.motion_noise(d)


@query("legacy_calibrate", WITH + " select round(quantile_cont(ldlj_wrist, 0.05), 6) as lo, round(quantile_cont(ldlj_wrist, 0.95), 6) as hi from m where valid")
def legacy_calibrate(spark, sf_dir):
    return rounded(L.brackets(m(spark, sf_dir), ["ldlj_wrist"]).drop("key"))


_PLACES = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99}


@query("exact_percentiles", "with u as (unpivot (select l_extendedprice::double as price, l_quantity::double as quantity, l_extendedprice * (1 - l_discount) * (1 + l_tax) as charge from lineitem) on price, quantity, charge into name name value v) select name, count(v) as n, " + ", ".join(f"round(quantile_cont(v, {q}), 4) as {k}" for k, q in _PLACES.items()) + " from u group by name")
def exact_percentiles(spark, sf_dir):
    """Three columns of every line, with brackets narrow enough to need more than one sketch."""
    d, price = B.table(spark, sf_dir, "lineitem"), F.col("l_extendedprice")
    columns = {"price": price, "quantity": F.col("l_quantity"), "charge": price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))}
    p, r = percentiles(d, {k: (c, list(_PLACES.values())) for k, c in columns.items()}, most=256)
    return small(spark, [(k, r[f"n_{k}"], *(round(x, 4) for x in p[k])) for k in columns], "name string, n bigint, " + ", ".join(f"{k} double" for k in _PLACES))

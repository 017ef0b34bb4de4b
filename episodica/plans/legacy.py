"""Queries over the earlier scores, grey frames and verdict replies."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import gray as G
from ..functions import verdicts as V
from ..operators import legacy as L
from ..operators import measure as M
from ..operators.selection import dealt
from . import bindings as B
from .motion import rounded
from .scoring import WITH, family_sql, m

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put


_W = "window w as (partition by episode, joint order by t, frame_index)"
_LEG = f"""with {B.FRAMES_SQL}, js as (select episode, frame_index, t, unnest([0, 1, 2, 3, 4]) as joint, unnest([s0, s1, s2, s3, s4]) as q, unnest([s0 + 0.01::double * (k % 5), s1 + 0.01::double * (k % 5), s2 + 0.01::double * (k % 5), s3 + 0.01::double * (k % 5), s4 + 0.01::double * (k % 5)]) as command from frames),
a1 as (select *, t - lag(t) over w as dt, q - lag(q) over w as dq, abs(command - lead(q) over w) > 7 as miss, t >= max(t) over (partition by episode) - 2 as late from js {_W}),
a2 as (select *, (dq - lag(dq) over w) / (lag(dt) over w * lag(dt) over w) as acc from a1 {_W}),
a3 as (select *, abs(acc) > 15 * median(abs(acc)) over (partition by episode, joint) as spike from a2),
fr as (select episode, frame_index, sqrt(sum(dq * dq)) as step, max(dt) as dt, sum(acc * acc) as acc2, count(acc) as n_acc, coalesce(bool_or(spike), false) as spike, bool_or(miss) as miss from a3 group by all),
jt as (select episode, joint, stddev_pop(q) filter (late) as late, arg_min(q, frame_index) as q0, arg_max(q, frame_index) as q1 from a3 group by all),
en as (select episode, avg(late) as late, sqrt(sum((q1 - q0) * (q1 - q0))) as straight from jt group by episode),
ps as (select episode, exp(-sqrt(sum(acc2) / sum(n_acc)) / 1000) as smoothness, sum(step) as path, 1 - avg((step / dt < 0.1)::int) as idle_velocity, greatest(0, 1 - avg(spike::int) filter (n_acc > 0)) as collision, exp(-4 * avg(miss::int)) as actuator_saturation from fr group by episode)
select episode, round(smoothness, 6) as smoothness, round(case when path < 1e-6 then 0 else greatest(0, least(1, straight / path)) end, 6) as path_efficiency, round(idle_velocity, 6) as idle_velocity, round(collision, 6) as collision, round(exp(-late / 0.05), 6) as joint_stability, round(actuator_saturation, 6) as actuator_saturation from ps join en using (episode)"""


def _long(spark, sf_dir):
    d = B.frames(spark, sf_dir).select("episode", "frame_index", "t", F.posexplode("state").alias("joint", "q"), "action")
    return d.withColumn("command", F.get("action", "joint")).drop("action")


@query("legacy_path_scores", _LEG)
def legacy_path_scores(spark, sf_dir):
    return rounded(L.path_scores(_long(spark, sf_dir)))


@query("legacy_gripper", f"with {B.FRAMES_SQL} select episode, round(coalesce(greatest(0, least(1, (avg(((value - prev <> 0) = (value - prev >= 0.5))::int) - 0.1) / 0.9)), 0.5), 6) as score from frames group by episode")
def legacy_gripper(spark, sf_dir):
    d = B.frames(spark, sf_dir).withColumn("grip", F.col("value") - F.coalesce(F.lag("value").over(M.by_t()), F.col("value")))
    return rounded(d.groupBy("episode").agg(L.gripper(F.col("grip")).alias("score")))


_SPARC = f"""with {B.FRAMES_SQL}, js as (select episode, frame_index, t, unnest([0, 1, 2, 3, 4]) as joint, unnest([s0, s1, s2, s3, s4]) as q from frames),
s as (select episode, joint, row_number() over w - 1 as i, count(*) over e as n, (max(t) over e - min(t) over e) / (count(*) over e - 1) as step,
  t - lag(t) over w as hs, lead(t) over w - t as hd, (q - lag(q) over w) / (t - lag(t) over w) as l, (lead(q) over w - q) / (lead(t) over w - t) as r
  from js window w as (partition by episode, joint order by frame_index), e as (partition by episode, joint)),
v as (select episode, joint, i, case when hs is null then r when hd is null then l else (hd * l + hs * r) / (hs + hd) end as v from s where n > 1),
b as (select distinct episode, joint, step, pow(2, ceil(log2(5 * n)))::bigint as bins from s where n > 1),
k as (select episode, joint, bins, unnest(generate_series(0, bins // 2 - 1)) as k, step from b),
x as (select episode, joint, k, sqrt(pow(sum(v * cos(2 * pi() * ((i * k) % bins) / bins)), 2) + pow(sum(v * sin(2 * pi() * ((i * k) % bins) / bins)), 2)) as a
  from (select * from k where k / (bins * step) <= 10) join v using (episode, joint) group by episode, joint, k),
p as (select episode, joint, k, a / coalesce(nullif(max(a) over (partition by episode, joint), 0), 1) as a from x),
c as (select *, a - lag(a) over (partition by episode, joint order by k) as da, coalesce(max(k) filter (a > 0.05) over (partition by episode, joint), max(k) over (partition by episode, joint)) as top from p),
o as (select episode, joint, case when max(top) = 0 then 0 else -sum(sqrt(1 / (top::double * top) + da * da)) filter (k > 0 and k <= top) end as sparc from c group by episode, joint)
select episode, joint::int as joint, round(sparc, 6) as sparc, round(least(exp(0.1 * (sparc + 1)), 1), 6) as score from o"""


@query("sparc", _SPARC)
def sparc(spark, sf_dir):
    return rounded(L.sparc(B.frames(spark, sf_dir)))


@query("time_stats", "select round(avg(o_totalprice), 4) as mean, round(stddev_pop(o_totalprice), 4) as std, round(quantile_cont(o_totalprice, 0.25), 4) as q1, round(quantile_cont(o_totalprice, 0.75), 4) as q3, round(median(o_totalprice), 4) as median, round(quantile_cont(o_totalprice, 0.75) - quantile_cont(o_totalprice, 0.25), 4) as iqr from orders")
def time_stats(spark, sf_dir):
    s = L.time_stats(B.table(spark, sf_dir, "orders"), "o_totalprice")
    return s.select(*[F.round(c, 4).alias(c) for c in s.columns])


_ST = "s as (select avg(duration_s) as mean, stddev_pop(duration_s) as std, quantile_cont(duration_s, 0.25) as q1, quantile_cont(duration_s, 0.75) as q3 from m)"


@query("outliers", WITH + f", {_ST} select episode, duration_s < q1 - 1.5 * (q3 - q1) or duration_s > q3 + 1.5 * (q3 - q1) as tukey, std > 0 and abs(duration_s - mean) / std > 3 as z, case when duration_s < q1 - 1.5 * (q3 - q1) or duration_s > q3 + 1.5 * (q3 - q1) then 0.0 else 1.0 end::double as runtime from m, s")
def outliers(spark, sf_dir):
    d = m(spark, sf_dir).select("episode", "duration_s")
    s = L.time_stats(d, "duration_s").first()
    args = [F.col("duration_s"), *[F.lit(s[k]) for k in ("mean", "std", "q1", "q3")]]
    return d.select("episode", L.outlier(*args).alias("tukey"), L.outlier(*args, how="z").alias("z"), L.runtime(L.outlier(*args)).alias("runtime"))


def _cameras(spark, sf_dir):
    li = B.table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n"))
    return li.select(F.col("l_orderkey").alias("episode"), F.col("l_returnflag").alias("camera"), F.col("q").cast("double").alias("q"), (F.col("q") / F.col("n") / 50).alias("total"))


_CAM = "with c as (select l_orderkey as episode, l_returnflag as camera, sum(l_quantity)::double as q, sum(l_quantity) / count(*) / 50 as total from lineitem group by all)"
for _how, _fn in (("all", "bool_and"), ("any", "bool_or")):

    def _good(how):
        @query(f"good_episodes_{how}", _CAM + f" select episode from c group by episode having {_fn}(total >= 0.5)")
        def run(spark, sf_dir):
            return L.good_episodes(_cameras(spark, sf_dir), 0.5, how)

    _good(_how)


@query("evaluate_episodes", _CAM + " select count(*) as n_rows, count(distinct episode) as n_episodes, round(avg(total), 6) as mean from c")
def evaluate_episodes(spark, sf_dir):
    return rounded(L.evaluate(_cameras(spark, sf_dir)))


_FAMILY = family_sql()
_Z = "((duration_s - 18.0) / 4.0)"
_H = f"""h as (select *, case when degenerate then 0 else coalesce({_FAMILY["smoothness"]}, 0) end as a, case when degenerate then 0 else coalesce({_FAMILY["acceleration"]}, 0) end as b,
case when degenerate then 0 when self_collision_suspect then least(0.2, coalesce({_FAMILY["contact"]}, 0)) else coalesce({_FAMILY["contact"]}, 0) end as c,
case when degenerate then 0 else 0.5 * coalesce(exp(-pow({_Z} / case when {_Z} >= 0 then 1.25 else 2.0 end, 2)), 1) + 0.3 * coalesce(greatest(0, least(1, 1 - idle_fraction)), 0)
  + 0.2 * case when grasp_transitions is null or grasp_transitions < 0 then 1 when grasp_incomplete then 0 else exp(-greatest(0, grasp_transitions - 4) / 2.0) end end as d,
{_FAMILY["video"]} as e from m)"""


@query("legacy_humanoid", WITH + f", {_H} select episode, round(a::double, 6) as smoothness, round(b::double, 6) as acceleration, round(c::double, 6) as collision, round(d::double, 6) as runtime, round(e::double, 6) as visual, round((0.2 * a + 0.2 * b + 0.2 * c + 0.2 * d + coalesce(0.2 * e, 0))::double / (0.8 + case when e is null then 0 else 0.2 end), 6) as aggregate from h")
def legacy_humanoid(spark, sf_dir):
    parts = [F.col(f"h_{k}").alias(k) for k in ("smoothness", "acceleration", "collision", "runtime", "visual")]
    return rounded(L.humanoid(m(spark, sf_dir), (18.0, 4.0)).select("episode", *parts, "aggregate"))


@query("legacy_weights", WITH + " select episode, round((20 * coalesce(video_contrast, 0) / 66 + 10 * (1 - idle_fraction))::double / 30, 6) as total, case when (20 * video_contrast / 66 + 10 * (1 - idle_fraction)) / 30 >= 0.65 then 'GOOD' else 'BAD' end as status from m")
def legacy_weights(spark, sf_dir):
    total = L.weighted({"visual_clarity": F.col("video_contrast") / 66, "smoothness": 1 - F.col("idle_fraction")})
    return m(spark, sf_dir).select("episode", F.round(total, 6).alias("total"), F.when(total >= L.GOOD, "GOOD").otherwise("BAD").alias("status"))


@query("score_breakdown", WITH + ", b as (select episode, unnest(['visual_clarity', 'smoothness']) as metric, unnest([video_contrast / 66, 1 - idle_fraction]) as score, unnest([20, 10]) as weight from m) select episode, metric, round(score * weight / 30, 6) as contribution, round(score * weight / nullif(sum(score * weight) over (partition by episode), 0), 6) as share from b")
def score_breakdown(spark, sf_dir):
    return rounded(L.breakdown(m(spark, sf_dir), {"visual_clarity": F.col("video_contrast") / 66, "smoothness": 1 - F.col("idle_fraction")}))


def _gray(spark, sf_dir):
    e = B.table(spark, sf_dir, "embeddings")
    pixel = lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x.cast("double") * 256 + 128.5).cast("int")))
    return e.select("vec_id", "label", F.transform("embedding", pixel).alias("gray"), F.lit(8).alias("h"), F.lit(8).alias("w"))


_GR = """with g as (select vec_id, label, list_transform(embedding, lambda x: least(255, greatest(0, floor(x::double * 256 + 128.5)::int))) as gray from embeddings),
px as (select vec_id, label, p, p // 8 as r, p % 8 as c, gray, gray[p + 1] as v from (select *, unnest(range(64)) as p from g)),
mi as (select *, case when r = 0 then 1 else r - 1 end as ru, case when r = 7 then 6 else r + 1 end as rd, case when c = 0 then 1 else c - 1 end as cl, case when c = 7 then 6 else c + 1 end as cr from px),
la as (select vec_id, label, v, gray[ru * 8 + c + 1] + gray[rd * 8 + c + 1] + gray[r * 8 + cl + 1] + gray[r * 8 + cr + 1] - 4 * v as lap from mi),
st as (select vec_id, any_value(label) as label, (sum(lap * lap) * 64 - sum(lap) * sum(lap))::double / 4096 as sharpness, avg(v) as brightness, sqrt((sum(v * v) * 64 - sum(v) * sum(v))::double / 4096) as contrast, avg((v > 250 or v < 5)::int) as clipped from la group by vec_id)"""


def _gray_stats(spark, sf_dir):
    g = _gray(spark, sf_dir)
    return g.select("vec_id", "label", G.variance(G.laplacian("gray", "h", "w")).alias("sharpness"), G.mean(F.col("gray")).alias("brightness"), F.sqrt(G.variance(F.col("gray"))).alias("contrast"), G.clipped(F.col("gray")).alias("clipped"))


@query("gray_stats", _GR + " select vec_id, round(sharpness, 2) as sharpness, round(brightness, 4) as brightness, round(contrast, 3) as contrast, round(clipped, 4) as clipped from st")
def gray_stats(spark, sf_dir):
    d = _gray_stats(spark, sf_dir).drop("label")
    return d.select("vec_id", *[F.round(c, {"sharpness": 2, "contrast": 3}.get(c, 4)).alias(c) for c in d.columns[1:]])


@query("interframe", "with g as (select vec_id, label, list_transform(embedding, lambda x: least(255, greatest(0, floor(x::double * 256 + 128.5)::int))) as gray from embeddings), p as (select *, lag(gray) over (partition by label order by vec_id) as prev from g), d as (select label, vec_id, list_avg(list_transform(range(1, 65), lambda i: abs(gray[i] - prev[i]))) as diff from p where prev is not null) select label, round(avg(diff), 4) as interframe_diff from d group by label")
def interframe(spark, sf_dir):
    w = W.partitionBy("label").orderBy("vec_id")
    d = _gray(spark, sf_dir).withColumn("prev", F.lag("gray").over(w)).where("prev is not null").withColumn("diff", G.mean_abs_difference(F.col("gray"), F.col("prev")))
    return d.groupBy("label").agg(F.round(F.avg("diff"), 4).alias("interframe_diff"))


@query("visual_clarity", _GR + ", q as (select label, row_number() over (partition by label order by vec_id) as i, greatest(greatest(0, least(1, 1 - least(sharpness / 80, 1))), 1 - brightness / 50) as pen from st) select label, round(greatest(0, 1 - avg(pen)), 6) as score from q where i % 4 = 0 group by label")
def visual_clarity(spark, sf_dir):
    return rounded(L.clarity(_gray_stats(spark, sf_dir), ["label"], "vec_id"))


@query(
    "frame_scores",
    _GR + ", wt as (select vec_id, sum(v * exp(-(pow(2.0 * c / 7 - 1, 2) + pow(2.0 * r / 7 - 1, 2)) / 0.5)) / sum(exp(-(pow(2.0 * c / 7 - 1, 2) + pow(2.0 * r / 7 - 1, 2)) / 0.5)) as level, avg(v) as mean, stddev_pop(v) as std from px group by vec_id), "
    "lv as (select vec_id, var_pop(lap) as lap from la group by vec_id) "
    "select vec_id, round(least(lap / 1000, 1), 6) as blur, round(mean / 255, 6) as darkness, round(least(std / 80, 1), 6) as contrast, round(greatest(0, 1 - abs(level - 127.5) / 127.5), 6) as exposure, round(greatest(0, 1 - abs(mean - 127.5) / 127.5), 6) as exposure_even from wt join lv using (vec_id)",
)
def frame_scores(spark, sf_dir):
    d = _gray(spark, sf_dir).withColumn("lap", G.laplacian("gray", "h", "w"))
    gray = F.col("gray")
    return rounded(d.select("vec_id", G.blur_score(F.col("lap")).alias("blur"), G.darkness_score(gray).alias("darkness"), G.contrast_score(gray).alias("contrast"), G.exposure_score("gray", "h", "w").alias("exposure"), G.exposure_score("gray", "h", "w", False).alias("exposure_even")))


_REPLY = """'{"observed_final_state": "' || event_type || '"' || case when k % 3 = 0 then chr(10) else ',' end || '"goal_predicate": "g", "predicate_holds": ' || case k % 4 when 0 then '"yes"' when 1 then '"no"' when 2 then '" NO "' else 'null' end || case when k % 5 = 0 then '' else ', "score": ' || cast(cast(k % 7 as double) / 4 as string) end || case when k % 6 = 0 then ',' else '' end || '}'"""


def _replies(spark, sf_dir):
    # a few files of narrow rows are too few tasks for the work on every reply
    e = dealt(B.table(spark, sf_dir, "events").select("event_id", "event_type", "props"), 50_000, "event_id")
    e = e.select("event_id", "event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.withColumn("reply", F.expr(_REPLY.replace("chr(10)", "'\\n'")))


_RS = "with e as (select event_id, event_type, (props->>'k')::int as k from events), r as (select *, " + _REPLY.replace("cast(cast(k % 7 as double) / 4 as string)", "((k % 7)::double / 4)::varchar") + " as reply from e)"


@query("json_repair", _RS + """ select event_id, regexp_replace(regexp_replace(reply, '("|\\d|\\]|\\}|true|false|null)(\\s*\\r?\\n\\s*)(")', '\\1,\\2\\3', 'g'), ',(\\s*[}\\]])', '\\1', 'g') as repaired from r""")
def json_repair(spark, sf_dir):
    return _replies(spark, sf_dir).select("event_id", V.repair_json(F.col("reply")).alias("repaired"))


@query("json_parse", _RS + """ select event_id, case when k % 3 = 0 or k % 6 = 0 then 'repaired' else 'clean' end as how, event_type as state from r""")
def json_parse(spark, sf_dir):
    text, note = V.parse(F.col("reply"))
    d = _replies(spark, sf_dir).select("event_id", text.alias("text"), note.alias("note"))
    return d.select("event_id", F.when(F.col("note") == "", "clean").otherwise("repaired").alias("how"), F.from_json("text", V.SCHEMA)["observed_final_state"].alias("state"))


_SC = "case when k % 5 = 0 then null else (k % 7)::double / 4 end"
_RECON = f"""rc as (select event_id, k, case k % 4 when 0 then 1.0 when 3 then {_SC} else case when k % 5 = 0 then 0.0 when {_SC} >= 1 then 0.5 when {_SC} in (0, 0.5) then {_SC} when {_SC} >= 0.25 then 0.5 else 0 end end::double as score,
case when k % 4 = 0 then case when {_SC} = 1 then '' else 'corrected' end when k % 4 = 3 then 'unreadable' when k % 5 = 0 then 'missing' when {_SC} >= 1 then 'corrected' when {_SC} in (0, 0.5) then '' else 'snapped' end as note from r)"""


def _verdicts(spark, sf_dir):
    text, _ = V.parse(F.col("reply"))
    d = _replies(spark, sf_dir).withColumn("v", F.from_json(text, V.SCHEMA))
    value, note = V.reconcile(F.col("v.predicate_holds"), F.col("v.score"))
    return d.select("event_id", "k", value.alias("score"), note.alias("note"))


@query("reconcile_score", _RS + f", {_RECON} select event_id, score, note from rc")
def reconcile_score(spark, sf_dir):
    return _verdicts(spark, sf_dir).drop("k")


@query("missing_keys", _RS + " select event_id, case when k % 5 = 0 then ['score'] else [] end as missing from r")
def missing_keys(spark, sf_dir):
    text, _ = V.parse(F.col("reply"))
    return _replies(spark, sf_dir).select("event_id", V.missing_keys(text).alias("missing"))


@query("verdict_stats", _RS + f", {_RECON} select round(avg(score), 6) as mean, count(*) filter (score = 1) as n_full, count(*) filter (score = 0.5) as n_half, count(*) filter (score = 0) as n_none, count(*) filter (note <> '') as n_corrected, count(*) filter (score is null) as n_errors from rc")
def verdict_stats(spark, sf_dir):
    return rounded(V.statistics(_verdicts(spark, sf_dir)))


@query("json_last_object")
def json_last_object(spark, sf_dir):
    t = B.table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat("text", F.lit(' {"a": {"turn": '), F.col("turn"), F.lit('}, } tail {"score": 1}')).alias("reply"))
    return t.select("conv_id", "turn", V.last_object(F.col("reply")).alias("last"))


def _log(spark, sf_dir):
    e = B.table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("line"), F.concat(F.lit("v"), F.col("user_id")).alias("video"), F.concat(F.lit(" "), F.col("event_type")).alias("task"), F.col("value").alias("score"), F.when(F.col("event_id") % 4 == 0, "timeout").otherwise("").alias("error"))


_LG = "with l as (select event_id as line, 'v' || user_id as video, event_type as task, value as score, case when event_id % 4 = 0 then 'timeout' else '' end as error from events), k as (select *, row_number() over (partition by video, task order by line desc) as rn from l)"


@query("cache_upsert", _LG + " select line, video, score, error from k where rn = 1")
def cache_upsert(spark, sf_dir):
    return V.latest(_log(spark, sf_dir)).select("line", "video", "score", "error")


@query("cache_pending", _LG + " select distinct video, task from k where rn = 1 and error <> ''")
def cache_pending(spark, sf_dir):
    log = _log(spark, sf_dir)
    return V.pending(log.select("video", F.trim("task").alias("task")).distinct(), log)

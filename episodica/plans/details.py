"""Queries over flat rows, whole-episode documents, notes and the remaining earlier scores."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import gray as G
from ..functions import replies as Y
from ..functions import series as Z
from ..functions import verdicts as V
from ..operators import detail as E
from ..operators import inject as I
from ..operators import legacy as L
from ..operators import measure as M
from ..operators import report as R
from ..operators import score as S
from ..sources import video
from . import bindings as B
from . import legacy as replies
from .legacy import _GR, _RS, _SC, _gray
from .motion import rounded
from .reports import _DEC, _decided, _points, quantiles
from .scoring import PROFILE, WITH, m

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put


_VOTES = ("impact", "base_vote", "tracking_vote")


@query(
    "contact_votes",
    B.ALL_SQL + ", v as (select episode, " + ", ".join(f"{c} and not coalesce(lag({c}) over w, false) as s_{c}" for c in _VOTES) + " from f4 window w as (partition by episode order by t, frame_index)) "
    "select episode, sum(s_impact::int)::bigint as impact_count, sum(s_base_vote::int)::bigint as base_disturbance_count, sum(s_tracking_vote::int)::bigint as tracking_divergence_count from v group by episode",
)
def contact_votes(spark, sf_dir):
    return M.measure(B.frames(spark, sf_dir), B.GROUPS).select("episode", "impact_count", "base_disturbance_count", "tracking_divergence_count")


_HEAVY = {"wrist_acc": "value * value", "base_acc": "value * value * value", "residual": "value * value * value * value"}
_HW = "e as (partition by episode), w as (partition by episode order by t, frame_index)"


@query(
    "vote_starts",
    f"with {B.FRAMES_SQL}, a as (select episode, frame_index, t, {', '.join(f'{v} as {c}' for c, v in _HEAVY.items())}, value as wrist_speed from frames), "
    f"b as (select *, {', '.join(f'median({c}) over e as med_{c}' for c in _HEAVY)}, {B.gradient_sql('wrist_speed')} as slope, quantile_cont(wrist_speed, 0.25) over e as p25, count(*) over e as n from a window {_HW}), "
    f"c as (select *, {', '.join(f'median(abs({c} - med_{c})) over e as mad_{c}' for c in _HEAVY)} from b window e as (partition by episode)), "
    f"d as (select *, coalesce({B._SPIKE('wrist_acc')} and slope < 0 and wrist_speed > greatest(p25, 1e-3), false) as impact, coalesce({B._SPIKE('base_acc')}, false) and n > 2 as base_vote, coalesce({B._SPIKE('residual')}, false) as tracking_vote from c), "
    "x as (select *, impact::int + base_vote::int + tracking_vote::int >= 2 as confirmed from d), "
    "s as (select episode, " + ", ".join(f"({c} and not coalesce(lag({c}) over w, false))::int as {c}" for c in (*_VOTES, "confirmed")) + " from x window w as (partition by episode order by t, frame_index)) "
    "select episode, sum(impact)::bigint as impact, sum(base_vote)::bigint as base, sum(tracking_vote)::bigint as tracking, sum(confirmed)::bigint as confirmed from s group by episode",
)
def vote_starts(spark, sf_dir):
    """The votes over heavy-tailed channels, so that each of them occurs."""
    v = {c: F.expr(x) for c, x in _HEAVY.items()} | {"wrist_speed": F.col("value")}
    d = M.contact_frames(B.frames(spark, sf_dir).select("episode", "frame_index", "t", *[c.alias(k) for k, c in v.items()]))
    n = lambda c: F.sum(F.col(c).cast("int"))
    return d.groupBy("episode").agg(n("impact_starts").alias("impact"), n("base_starts").alias("base"), n("tracking_starts").alias("tracking"), n("starts").alias("confirmed"))


_TEXT = f"({_SC})::varchar"
_SAID = (
    f"case when k % 4 = 0 then case when {_SC} = 1 then '' else 'score corrected ' || coalesce({_TEXT}, 'None') || ' -> 1.0 (predicate_holds=yes)' end "
    f"when k % 4 = 3 then 'predicate_holds unreadable: None' when k % 5 = 0 then 'score missing, defaulted to 0.0 (predicate_holds=no)' "
    f"when {_SC} >= 1 then 'score corrected ' || {_TEXT} || ' -> 0.5 (predicate_holds=no)' when {_SC} in (0, 0.5) then '' "
    f"else 'score snapped ' || {_TEXT} || ' -> ' || case when {_SC} >= 0.25 then '0.5' else '0.0' end end"
)


@query("reconcile_notes", _RS + f" select event_id, {_SAID} as note from r")
def reconcile_notes(spark, sf_dir):
    d = replies._replies(spark, sf_dir).withColumn("v", F.from_json(V.parse(F.col("reply"))[0], V.SCHEMA))
    return d.select("event_id", Y.reconcile_note(F.col("v.predicate_holds"), F.col("v.score")).alias("note"))


def _messages(spark, sf_dir):
    """A message per event: the reply in its content or, every third time, in its reasoning."""
    d = replies._replies(spark, sf_dir)
    late = F.col("k") % 3 == 1
    body = F.struct(F.when(~late, F.col("reply")).otherwise("").alias("content"), F.when(late, F.col("reply")).alias("reasoning"))
    finish = F.when(F.col("k") % 11 == 0, "length").otherwise("stop")
    return d.select("event_id", "k", F.to_json(body).alias("message"), finish.alias("finish_reason"), F.lit(0).alias("prompt_tokens"), F.lit(0).alias("completion_tokens"))


_OK = "k % 5 <> 0"


@query(
    "judge_replies",
    _RS + f", n as (select *, {_SAID} as said, case when k % 11 = 0 then '{Y.TRUNCATED}' end as cut, case when k % 3 = 0 or k % 6 = 0 then '{V.REPAIRED}' end as mended, "
    f"case k % 4 when 0 then 1.0 when 3 then {_SC} else case when {_SC} >= 1 then 0.5 when {_SC} in (0, 0.5) then {_SC} when {_SC} >= 0.25 then 0.5 else 0 end end::double as s from r) "
    f"select event_id, case when {_OK} then s end as score, case when {_OK} then concat_ws('; ', cut, mended, nullif(said, '')) else coalesce(cut, '') end as note, "
    f"case when {_OK} then '' else '{Y.STOPPED % 'score'}' end as error from n",
)
def judge_replies(spark, sf_dir):
    return Y.judged(_messages(spark, sf_dir)).select("event_id", "score", "note", "error")


@query("score_rows", _DEC + " select episode, round(total, 6) as total, round(severity, 6) as severity, decision, round(smoothness, 6) as smoothness, round(video, 6) as video, degenerate, video_frozen, semantic from dec")
def score_rows(spark, sf_dir):
    return rounded(E.score_rows(_decided(spark, sf_dir)).select("episode", "total", "severity", "decision", "smoothness", "video", "degenerate", "video_frozen", "semantic"))


@query("measure_table")
def measure_table(spark, sf_dir):
    return E.measure_table(m(spark, sf_dir))


def _tracks(spark, sf_dir, limit=3000):
    p = _points(spark, sf_dir).withColumns({"y": F.nullif(F.col("y"), F.lit(0.0)), "key": F.lit("value"), "reference": F.when(F.col("episode") % 2 == 0, 450.0)})
    return E.tracks(p, limit)


@query(
    "track_axis",
    f"with {B.FRAMES_SQL}, x as (select episode, min(nullif(value, 0)) as low, max(nullif(value, 0)) as high, case when episode % 2 = 0 then 450.0::double end as reference from frames group by episode), "
    "y as (select *, least(0.0::double, coalesce(low, 0)) as lo, greatest(coalesce(high, 1.0::double), reference) as top from x) "
    "select episode, round(coalesce(low, 0), 5) as min, round(coalesce(high, 1), 5) as max, lo, case when top - lo < 1e-9 then lo + 1 else top end as hi from y",
)
def track_axis(spark, sf_dir):
    return _tracks(spark, sf_dir).select("episode", "min", "max", "lo", "hi")


@query("episode_detail")
def episode_detail(spark, sf_dir):
    f = B.frames(spark, sf_dir)
    spans = lambda c: Z.spans(f.select("episode", "t", c.alias("mask")))
    videos = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode"), F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z]", "")).alias("camera"), F.concat(F.lit("clip-"), F.col("o_orderkey")).alias("path"))
    discarded = B.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("episode"))
    scored = _decided(spark, sf_dir)
    return E.episode_detail(scored, _tracks(spark, sf_dir, 400), spans(F.col("value") > 100), spans(F.col("value") < 10), PROFILE, videos, discarded)


@query(
    "by_episode",
    f"with {B.FRAMES_SQL}, g as (select episode, count(*) as length, max(t) as last_t, sum(s0) as q_sum, sum(s1 + 0.01::double * (k % 5)) as a_sum, (episode % 7)::int as task_index from frames group by episode) "
    "select episode, length, (sum(length) over (order by episode) - length)::bigint as start, last_t, round(q_sum, 6) as q_sum, round(a_sum, 6) as a_sum, coalesce(r_name, 'AFRICA') as task from g left join region on r_regionkey = task_index",
)
def by_episode(spark, sf_dir):
    known = B.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("task_index"), F.col("r_name").alias("task"))
    frames = B.frames(spark, sf_dir).select("episode", "frame_index", "t", "state", "action", F.lit(None).cast("array<double>").alias("eef"), (F.col("episode") % 7).cast("int").alias("task_index"))
    d = E.by_episode(frames, known, "AFRICA")
    total = lambda a, x: F.aggregate(a, F.lit(0.0), lambda s, v: s + x(v))
    return rounded(
        d.select("episode", "length", "start", F.element_at("states", -1)["t"].alias("last_t"), total(F.col("states"), lambda v: v["q"][0]).alias("q_sum"), total(F.col("actions"), lambda v: v[1]).alias("a_sum"), "task")
    )


_GOOD_SQL = f"{B.FRAMES_SQL}, g as (select episode from frames group by episode having avg(value) > 50)"


@query("eval_split", f"with {_GOOD_SQL}, n as (select episode, row_number() over (order by episode) - 1 as filtered, count(*) over () as n from g) select episode, filtered::bigint as filtered from n where filtered < floor(0.4 * n)")
def eval_split(spark, sf_dir):
    good = B.frames(spark, sf_dir).groupBy("episode").agg(F.avg("value").alias("v")).where("v > 50").select("episode")
    return E.eval_split(good, 0.4)


@query("quantile_pick")
def quantile_pick(spark, sf_dir):
    q = quantiles(spark, sf_dir)
    return E.pick(q, 0, 3).unionByName(E.pick(q, 3, 3, "random"))


@query("orphans_of_orders", "select distinct o_orderkey as episode from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def orphans_of_orders(spark, sf_dir):
    data = B.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("episode"))
    return R.orphans(B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode")).distinct(), data)


@query("unreadable", "select o_orderkey as episode, 'top' as camera from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 25)")
def unreadable(spark, sf_dir):
    segments = B.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode"), F.lit("top").alias("camera"))
    return E.unreadable(segments, B.table(spark, sf_dir, "lineitem").where("l_quantity > 25").select(F.col("l_orderkey").alias("episode"), F.lit("top").alias("camera")))


@query("legacy_degenerate", WITH + " select episode, duration_s <= 12 or case when nullif(eef_path_m, 1.0) is not null then eef_path_m < 0.30 else arm_speed_rms < 0.5 end as degenerate from m")
def legacy_degenerate(spark, sf_dir):
    return m(spark, sf_dir).select("episode", L.degenerate(F.col("duration_s") - 12, F.expr("nullif(eef_path_m, 1.0)"), F.col("arm_speed_rms"), least_speed=0.5).alias("degenerate"))


@query("robust_time_stats", WITH + ", k as (select median(duration_s) as md from m) select round(any_value(md), 6) as median, round(1.4826 * median(abs(duration_s - md)), 6) as mad, round(avg(duration_s), 6) as mean, round(stddev_pop(duration_s), 6) as std from m, k")
def robust_time_stats(spark, sf_dir):
    return rounded(L.robust_time_stats(m(spark, sf_dir), "duration_s"))


_AT = lambda r, c: f"gray[{r} * 8 + {c} + 1]"
_NINE = f"4 * v + 2 * ({_AT('ru', 'c')} + {_AT('rd', 'c')} + {_AT('r', 'cl')} + {_AT('r', 'cr')}) + {_AT('ru', 'cl')} + {_AT('ru', 'cr')} + {_AT('rd', 'cl')} + {_AT('rd', 'cr')}"


@query("image_blur", _GR + f" select vec_id, list(floor(({_NINE}) / 16.0::double + 0.5)::int order by p) as gray from mi group by vec_id")
def image_blur(spark, sf_dir):
    return _gray(spark, sf_dir).select("vec_id", G.blur(F.col("gray"), "h", "w", 3).alias("gray"))


@query("inject_image_faults")
def inject_image_faults(spark, sf_dir):
    d = _gray(spark, sf_dir).select(F.col("label").cast("long").alias("episode"), F.lit("top").alias("camera"), F.col("vec_id").cast("int").alias("frame_index"), F.col("h").alias("height"), F.col("w").alias("width"), "gray")
    return I.image_faults(d)


_CLIP = 20


@query(
    "video_measures",
    _GR + """, pairs as (select vec_id, list_avg(list_transform(range(1, 65), lambda i: abs(gray[i] - prev[i]))) as diff from (select *, lag(gray) over (partition by label order by vec_id) as prev from g) where prev is not null),
    seq as (select st.*, diff, row_number() over (partition by label order by vec_id) - 1 as i, count(*) over (partition by label) as n from st left join pairs using (vec_id))
    select label::bigint as episode, 1.0::double as video_decode_ratio, round(avg(sharpness) filter (i % greatest(n // 16, 1) = 0), 2) as video_sharpness, round(avg(brightness) filter (i % greatest(n // 16, 1) = 0), 4) as video_brightness,
      round(avg(contrast) filter (i % greatest(n // 16, 1) = 0), 3) as video_contrast, round(avg(clipped) filter (i % greatest(n // 16, 1) = 0), 4) as video_clipped_fraction, round(avg(diff), 4) as video_interframe_diff
    from seq group by label""",
)
def video_measures(spark, sf_dir):
    """Grey frames of one label as a clip, cut into segments that are decoded and folded one by one; a segment's path holds its frames."""

    def decoder(path, from_s, to_s):
        for x in json.loads(path):
            yield x["i"], x["declared"], 8, 8, x["gray"]

    w = W.partitionBy("label")
    d = _gray(spark, sf_dir).withColumn("i", F.row_number().over(w.orderBy("vec_id")) - 1).withColumn("declared", F.count("*").over(w))
    path = F.to_json(F.array_sort(F.collect_list(F.struct("i", "declared", "gray"))))
    none = F.lit(None).cast("double")
    segments = d.groupBy("label", F.expr(f"i div {_CLIP}").alias("part")).agg(path.alias("path")).select(F.col("label").cast("long").alias("episode"), F.lit("top").alias("camera"), "path", none.alias("from_s"), none.alias("to_s"))
    got = M.video_of(video.fold(segments, decoder, M.DIFF_WIDTH, M.SAMPLES))
    places = {"video_decode_ratio": None, "video_sharpness": 2, "video_brightness": 4, "video_contrast": 3, "video_clipped_fraction": 4, "video_interframe_diff": 4}
    return got.select("episode", *[(F.col(c) if n is None else F.round(c, n)).alias(c) for c, n in places.items()])

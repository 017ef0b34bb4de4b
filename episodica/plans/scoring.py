"""Queries over measured rows: kernels on columns, fits, scores and decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import kernels as K
from ..operators import fit as T
from ..operators import score as S
from . import bindings as B
from .motion import rounded

QUERIES: dict = {}
SQL: dict[str, str] = {}
WITH = f"with {B.MEASURES_SQL}\n"


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return put


def m(spark, sf_dir):
    return B.measures(spark, sf_dir)


def _ramp(v: str, lo: float, hi: float) -> str:
    return f"case when {v} is null then 0 else greatest(0, least(1, ({v} - ({lo})::double) / (({hi})::double - ({lo})::double))) end"


def _simple(name: str, column, sql: str):
    @query(name, WITH + f"select episode, round(({sql})::double, 6) + 0.0 as v from m")
    def run(spark, sf_dir):
        return m(spark, sf_dir).select("episode", (F.round(column(), 6) + 0.0).alias("v"))


_simple("ramp", lambda: K.ramp(F.col("ldlj_body"), -21.4, -18.5), _ramp("ldlj_body", -21.4, -18.5))
_simple("gauss", lambda: K.gauss((F.col("duration_s") - 20) / 5), "exp(-pow((duration_s - 20) / 5 / case when duration_s >= 20 then 1.25 else 2.0 end, 2))")
_simple("exp_decay", lambda: K.decay(F.col("contact_rate_hz"), 0.5), "exp(-greatest(contact_rate_hz, 0) / 0.5)")
_simple("robust_z", lambda: K.robust_z(F.col("duration_s"), 20.0, 3.5), "(duration_s - 20) / 3.5")
_simple("smoothstep", lambda: K.smoothstep(F.col("idle_fraction") * 2 - 0.3), "3 * pow(greatest(0, least(1, idle_fraction * 2 - 0.3)), 2) - 2 * pow(greatest(0, least(1, idle_fraction * 2 - 0.3)), 3)")
_COMBINE = {"a": ("ldlj_body", 0.5, -21.4, -18.5), "b": ("acc_wrist_p99", 0.3, 12.1, 5.8), "c": ("video_contrast", 0.2, 30.0, 60.0)}
_parts = lambda: {k: (F.when(F.col(c).isNotNull(), K.ramp(F.col(c), lo, hi)), w) for k, (c, w, lo, hi) in _COMBINE.items()}
_W = " + ".join(f"case when {c} is null then 0 else {w} end" for c, w, _, _ in _COMBINE.values())
_simple("combine_geometric", lambda: K.combine(_parts()), "exp((" + " + ".join(f"case when {c} is null then 0 else {w} * ln(greatest(0.02, {_ramp(c, lo, hi)})) end" for c, w, lo, hi in _COMBINE.values()) + f") / ({_W}))")
_simple("combine_arithmetic", lambda: K.combine(_parts(), "arithmetic"), "(" + " + ".join(f"case when {c} is null then 0 else {w} * {_ramp(c, lo, hi)} end" for c, w, lo, hi in _COMBINE.values()) + f") / ({_W})")
_U = "((ldlj_body + 20.9) / (-23.4 + 20.9))"
_STEP = "(0.98 * (3 * pow(greatest(0, least(1, u)), 2) - 2 * pow(greatest(0, least(1, u)), 3)))"
_P = f"(case when u is null then null when u <= 0 then 0 when u <= 1 then {_STEP} else 1 - pow(0.02::double, least(u, 50)) end)"
_COST = f"(case when u is null then null when u <= 0 then 0 when u <= 1 then -ln(greatest(1 - {_STEP}, 1e-300)) else least(u, 50) * -ln(0.02::double) end)"
_pos = lambda: K.position(F.col("ldlj_body"), -20.9, -23.4)
_simple("criterion_position", _pos, _U)
_simple("criterion_violation", lambda: K.violation(_pos()), _P.replace("u <", f"{_U} <").replace("u is", f"{_U} is").replace("least(1, u)", f"least(1, {_U})").replace("least(u,", f"least({_U},"))
_simple("criterion_cost", lambda: K.cost(_pos()), _COST.replace("u <", f"{_U} <").replace("u is", f"{_U} is").replace("least(1, u)", f"least(1, {_U})").replace("least(u,", f"least({_U},"))


@query("sharpness_fit", WITH + "select round(regr_intercept(video_sharpness, arm_speed_rms), 6) as intercept, round(regr_slope(video_sharpness, arm_speed_rms), 6) as slope from m where valid and video_decodable")
def sharpness_fit(spark, sf_dir):
    c, k = T.sharpness_line(m(spark, sf_dir).where("valid"))
    return spark.range(1).select(F.round(F.lit(c), 6).alias("intercept"), F.round(F.lit(k), 6).alias("slope"))


@query("histogram", WITH + "select b::int as bin, count(v)::bigint as n from range(20) r(b) left join (select least(floor(idle_fraction * 20), 19) as v from m where idle_fraction between 0 and 1) on v = b group by b")
def histogram(spark, sf_dir):
    bins = spark.range(20).select(F.col("id").cast("int").alias("bin"))
    got = m(spark, sf_dir).select(K.bin20(F.col("idle_fraction")).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    return bins.join(got, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


_BR = {k: v for k, v in T.BRACKETS.items()}


@query("calibration_fit", WITH + ", k as (unpivot (select " + ", ".join(_BR) + " from m where valid) on " + ", ".join(_BR) + " into name quantity value v) select quantity, round(case when quantity like 'acc%' then quantile_cont(v, 0.95) else quantile_cont(v, 0.05) end, 6) as worst, round(case when quantity like 'acc%' then quantile_cont(v, 0.05) else quantile_cont(v, 0.95) end, 6) as best from k group by quantity")
def calibration_fit(spark, sf_dir):
    c = T.fit_calibration(m(spark, sf_dir))
    rows = ", ".join(f"('{k}', {a!r}D, {b!r}D)" for k, (a, b) in c.brackets.items() if k in T.BRACKETS)
    return rounded(spark.sql(f"select * from values {rows} as t(quantity, worst, best)"))


@query("calibration_scalars", WITH + ", v as (select *, median(duration_s) over () as md from m where valid) select round(any_value(md), 6) as duration_median, round(median(abs(duration_s - md)) * 1.4826, 6) as duration_mad, (select grasp_transitions from m where valid and grasp_transitions >= 2 group by 1 order by count(*) desc, 1 limit 1) as grasp_nominal, count(*) as n from v")
def calibration_scalars(spark, sf_dir):
    c = T.fit_calibration(m(spark, sf_dir))
    return spark.sql(f"select round({c.duration_median!r}D, 6) as duration_median, round({c.duration_mad!r}D, 6) as duration_mad, {c.grasp_nominal} as grasp_nominal, {c.n_episodes_fitted}L as n")


_SIMPLE_FITTED = [q for q in T.FITTED if q != "video_sharpness_residual"]
_SIGN = lambda q: "case when quantity like 'acc%' then 1 else -1 end"


@query("profile_fit", WITH + ", k as (unpivot (select " + ", ".join("case when video_decodable then video_contrast end as video_contrast" if q == "video_contrast" else q for q in _SIMPLE_FITTED) + " from m where valid) on " + ", ".join(_SIMPLE_FITTED) + " into name quantity value v), a as (select *, median(v) over (partition by quantity) as md from k) select quantity, round(any_value(md) + " + _SIGN(0) + " * 1.4826 * median(abs(v - md)), 3) + 0.0 as good, round(any_value(md) + " + _SIGN(0) + " * 4 * 1.4826 * median(abs(v - md)), 3) + 0.0 as bad from a group by quantity")
def profile_fit(spark, sf_dir):
    p = T.fit_profile(m(spark, sf_dir))
    rows = ", ".join(f"('{c.quantity}', {c.good!r}D, {c.bad!r}D)" for c in p.criteria if c.quantity in _SIMPLE_FITTED)
    return spark.sql(f"select quantity, round(good, 3) + 0.0D as good, round(bad, 3) + 0.0D as bad from values {rows} as t(quantity, good, bad)")


def _rule_sql(k: str) -> str:
    v = "duration_s" if k == "duration_short_s" else k
    return f"case when video_decodable then {v}::double end" if v.startswith("video_") else f"{v}::double"


_RULE_ROWS = " union all ".join(f"select '{k}' as quantity, '{op}' as op, {pct / 100} as seed, {_rule_sql(k)} as v from m where valid" for k, (op, pct) in T.RULE_SEEDS.items())


@query("suggest_rules", WITH + f", r as ({_RULE_ROWS}) select quantity, op, round(case seed when 0.02 then quantile_cont(v, 0.02) when 0.95 then quantile_cont(v, 0.95) else quantile_cont(v, 0.98) end, 4) as \"limit\", false as enabled from r group by quantity, op, seed having count(v) >= 3")
def suggest_rules(spark, sf_dir):
    return T.suggest_rules(m(spark, sf_dir))


PROFILE = T.Profile(task_duration_s=18.0, sharpness_intercept=90.0, sharpness_slope=-5.0)


def _quantity_sql(k: str) -> str:
    special = {
        "grasp_excess": "case when grasp_transitions >= 0 and not grasp_incomplete then greatest(0, grasp_transitions - 4)::double end",
        "duration_ratio": "duration_s / 18.0", "duration_ratio_short": "duration_s / 18.0", "video_brightness_dev": "abs(video_brightness - 127.5)",
        "video_sharpness_residual": "video_sharpness - (90.0 - 5.0 * arm_speed_rms)",
    }
    return special.get(k) or (f"case when video_decodable then {k} end" if k.startswith("video_") else f"{k}::double")


_ROWS = " union all ".join(
    f"select episode, valid, {i} as rank, '{c.quantity}' as quantity, '{c.family}' as family, '{c.action}' as action, {c.weight}::double as weight, {c.good}::double as good, {c.bad}::double as bad, ({_quantity_sql(c.quantity)})::double as value from m"
    for i, c in enumerate(T.CRITERIA)
)
PEN = WITH + f", r as ({_ROWS}), ru as (select *, (value - good) / (bad - good) as u from r), pen as (select *, {_P} as p, {_COST} as cost from ru)"


@query("penalties", PEN + " select episode, quantity, round(u, 6) + 0.0 as u, round(p, 6) as p, round(cost, 6) + 0.0 as cost from pen")
def penalties(spark, sf_dir):
    d = S.penalties(m(spark, sf_dir), PROFILE)
    return d.select("episode", "quantity", (F.round("u", 6) + 0.0).alias("u"), F.round("p", 6).alias("p"), (F.round("cost", 6) + 0.0).alias("cost"))


ABS = PEN + ", ab as (select m.*, severity, case when severity >= 700 then 0 else exp(-severity) end as total from m left join (select episode, sum(weight * cost) as severity from pen where action <> 'review' and weight > 0 group by episode) using (episode))"


@query("score_absolute", ABS + " select episode, round(severity, 5) as severity, round(total, 6) as total from ab")
def score_absolute(spark, sf_dir):
    return S.score_absolute(m(spark, sf_dir), PROFILE).select("episode", F.round("severity", 5).alias("severity"), F.round("total", 6).alias("total"))


@query("family_view", PEN + " select episode, family, round(exp(-sum(weight * cost)), 6) as score from pen where weight > 0 and cost is not null group by episode, family")
def family_view(spark, sf_dir):
    return rounded(S.family_view(m(spark, sf_dir), PROFILE))


@query("top_offenders", PEN + " select episode, place, quantity from (select *, row_number() over (partition by episode order by round(weight * cost, 9) desc, rank)::int as place from pen where action <> 'review' and weight * cost > 0) where place <= 3")
def top_offenders(spark, sf_dir):
    return S.top_offenders(m(spark, sf_dir), PROFILE).select("episode", "place", "quantity")


@query("drift_report", PEN + " select quantity, count(value)::bigint as n, round(median(value), 6) as median_value, round(median(u), 6) + 0.0 as median_u, round(avg((u > 0)::int), 6) as over_good, round(avg((u >= 1)::int), 6) as over_bad from pen where valid group by quantity")
def drift_report(spark, sf_dir):
    return rounded(T.drift(m(spark, sf_dir), PROFILE).drop("label")).withColumn("median_u", F.col("median_u") + 0.0)


_HARD = "degenerate or grasp_incomplete or video_unreadable or video_truncated"
_SOFT = "self_collision_suspect or video_frozen"


@query("decide_absolute", ABS + f", pc as (select episode, p as pc from pen where quantity = 'contact_rate_hz') select episode, case when {_HARD} then 'reject' when semantic <= 0 then 'reject' when total is null then 'review' when total < 0.5 then 'reject' when {_SOFT} or pc > 0.5 or semantic < 1 then 'review' else 'accept' end as decision from ab join pc using (episode)")
def decide_absolute(spark, sf_dir):
    return S.decide_absolute(S.score_absolute(m(spark, sf_dir), PROFILE), PROFILE).select("episode", "decision")


def _comb(parts: list[tuple[str, str, float]], mode: str) -> str:
    w = " + ".join(f"case when {ok} then {x} else 0 end" for ok, _, x in parts)
    one = "ln(greatest(0.02, {s}))" if mode == "geometric" else "({s})"
    v = " + ".join(f"case when {ok} then {x} * {one.format(s=s)} else 0 end" for ok, s, x in parts)
    out = f"(({v})::double / nullif(({w})::double, 0))"
    return f"exp({out})" if mode == "geometric" else out


CAL = T.Calibration(duration_median=18.0, duration_mad=4.0)
_R = lambda k: _ramp(k, *T.BRACKETS[k])


def family_sql(mode: str = "geometric") -> dict[str, str]:
    z = "((duration_s - 18.0) / 4.0)"
    return {
        "smoothness": _comb([(f"{k} is not null", _R(k), w) for k, w in (("ldlj_wrist", 0.5), ("ldlj_arm", 0.3), ("ldlj_body", 0.2))], mode),
        "acceleration": _comb([(f"acc_{n}_rms is not null or acc_{n}_p99 is not null", f"least({_R(f'acc_{n}_rms')}, {_R(f'acc_{n}_p99')})", 1.0) for n in ("arm", "body", "wrist")], mode),
        "contact": "exp(-greatest(contact_rate_hz, 0) / 0.5)",
        "timing": _comb([("duration_s is not null", f"exp(-pow({z} / case when {z} >= 0 then 1.25 else 2.0 end, 2))", 0.5), ("idle_fraction is not null", _ramp("idle_fraction", 1.0, 0.25), 0.3), ("grasp_transitions >= 0 and not grasp_incomplete", "exp(-greatest(0, grasp_transitions - 4) / 2.0)", 0.2)], mode),
        "video": f"case when video_decodable is null then null when not video_decodable or video_truncated then 0 else least(case when video_interframe_diff < 1 then greatest(0, video_interframe_diff) else 1 end, greatest(0, least(1, 1 - video_clipped_fraction / 0.02))) * (0.45 * greatest(0, least(1, {_ramp('video_sharpness', 58, 110)} + greatest(0, least(0.5, arm_speed_rms / 1.5)))) + 0.30 * greatest(0, least(1, 1 - abs(video_brightness - 127.5) / 127.5)) + 0.25 * {_R('video_contrast')}) end",
    }


def _scored(mode: str = "geometric") -> str:
    fam = ", ".join(f"({v})::double as {k}" for k, v in family_sql(mode).items())
    total = _comb([(f"{k} is not null", k, w) for k, w in S.WEIGHTS.items() if w > 0], mode)
    return WITH + f", fam as (select *, {fam} from m), sc as (select *, coalesce({total}, 0) as total from fam), scored as (select *, -ln(greatest(total, 1e-12)) as severity from sc)"


for _name in S.FAMILIES:

    def _family(name):
        @query(f"score_{name}", _scored() + f" select episode, round({name}, 6) + 0.0 as score from scored")
        def run(spark, sf_dir):
            return S.score(m(spark, sf_dir), CAL).select("episode", (F.round(name, 6) + 0.0).alias("score"))

    _family(_name)


@query("score_total", _scored() + " select episode, round(total, 6) as total, round(severity, 6) as severity from scored")
def score_total(spark, sf_dir):
    return rounded(S.score(m(spark, sf_dir), CAL).select("episode", "total", "severity"))


@query("score_total_arithmetic", _scored("arithmetic") + " select episode, round(total, 6) as total, round(severity, 6) as severity from scored")
def score_total_arithmetic(spark, sf_dir):
    return rounded(S.score(m(spark, sf_dir), CAL, mode="arithmetic").select("episode", "total", "severity"))


_TAIL = f"when {_SOFT} or contact_rate_hz > 0.5 or semantic < 1 then 'review' else 'accept' end as decision from scored"
_HEAD = f" select episode, case when {_HARD} then 'reject' when semantic <= 0 then 'reject' "


def _decision(spark, sf_dir, policy):
    return S.decide(S.score(m(spark, sf_dir), CAL), policy).select("episode", "decision")


@query("decide_gate", _scored() + _HEAD + "when smoothness < 0.35 or acceleration < 0.35 or timing < 0.35 or video < 0.35 then 'reject' " + _TAIL)
def decide_gate(spark, sf_dir):
    return _decision(spark, sf_dir, S.Policy(minimums={"contact": 0.0}))


@query("decide_weighted", _scored() + _HEAD + f"when total < 0.35 then 'reject' when timing < 0.3 then 'review' " + _TAIL)
def decide_weighted(spark, sf_dir):
    return _decision(spark, sf_dir, S.Policy(mode="weighted", minimums={"timing": 0.3}))


RULES = (S.Rule("acc_arm_rms", 9.0), S.Rule("ldlj_wrist", -21.5, "<"), S.Rule("idle_fraction", 0.6, ">", "review"), S.Rule("video_sharpness", 60.0, "<", "review"))


@query("decide_rules", _scored() + _HEAD + "when acc_arm_rms > 9.0 or ldlj_wrist < -21.5 then 'reject' when idle_fraction > 0.6 or (video_decodable and video_sharpness < 60) then 'review' " + _TAIL)
def decide_rules(spark, sf_dir):
    return _decision(spark, sf_dir, S.Policy(mode="rules", rules=RULES))


@query("decide_limits", _scored() + f" select episode, case when {_HARD} then 'reject' when max_base_tilt_deg > 22 then 'reject' when semantic <= 0 then 'reject' when total < 0.35 then 'reject' " + _TAIL)
def decide_limits(spark, sf_dir):
    return _decision(spark, sf_dir, S.Policy(mode="weighted", limits=(S.Rule("max_base_tilt_deg", 22.0),)))


_LIST = lambda parts: f"list_filter([{', '.join(parts)}], lambda x: x is not null)"
_IF = lambda ok, text, v: f"case when {ok} then printf('{text}', {v}) end"
_FLAGS = lambda flags: [f"case when {f} then 'flag:{f}' end" for f in flags]


def _reasons(low: list[tuple[str, str, str]], review: list[str], minimums: list[str]) -> str:
    """A policy's reasons: low has condition, text and value of its rejections."""
    last = [*review, *_FLAGS(S.SOFT), *minimums, _IF("contact_rate_hz > 0.5", "contact (%.2f Hz)", "contact_rate_hz"), _IF("semantic < 1", "semantic %g", "semantic")]
    return (
        f"case when {_HARD} then {_LIST(_FLAGS(S.HARD))} when max_base_tilt_deg > 22 then [printf('limit:max_base_tilt_deg>22 (got %.3g)', max_base_tilt_deg)] when semantic <= 0 then ['semantic:goal not reached'] "
        f"when {' or '.join(ok for ok, _, _ in low)} then {_LIST([_IF(*x) for x in low])} else {_LIST(last)} end"
    )


_TILT = (S.Rule("max_base_tilt_deg", 22.0),)
#: Of each policy, how it decides and its reasons as SQL.
EXPLAINED = {
    "gate": (S.Policy(minimums={"contact": 0.0}, limits=_TILT), _reasons([(f"{n} < 0.35", f"{n} %.3f < 0.35", n) for n in ("smoothness", "acceleration", "timing", "video")], [], [])),
    "weighted": (S.Policy(mode="weighted", minimums={"timing": 0.3}, limits=_TILT), _reasons([("total < 0.35", "score %.3f < 0.35", "total")], [], [_IF("timing < 0.3", "timing %.3f < 0.3", "timing")])),
    "rules": (
        S.Policy(mode="rules", rules=RULES, limits=_TILT),
        _reasons(
            [("acc_arm_rms > 9.0", "arm acceleration RMS > 9 rad/s² (got %.4g)", "acc_arm_rms"), ("ldlj_wrist < -21.5", "wrist smoothness (LDLJ) < -21.5 (got %.4g)", "ldlj_wrist")],
            [_IF("idle_fraction > 0.6", "idle fraction > 0.6 (got %.4g)", "idle_fraction"), _IF("video_decodable and video_sharpness < 60", "sharpness < 60 lap.var (got %.4g)", "video_sharpness")], [],
        ),
    ),
}


@query("decision_reasons", _scored() + f" select episode, {EXPLAINED['gate'][1]} as reasons from scored")
def decision_reasons(spark, sf_dir):
    return S.decide(S.score(m(spark, sf_dir), CAL), EXPLAINED["gate"][0]).select("episode", "reasons")


@query("decision_reasons_all", _scored() + " " + " union all ".join(f"select episode, '{mode}' as mode, {sql} as reasons from scored" for mode, (_, sql) in EXPLAINED.items()))
def decision_reasons_all(spark, sf_dir):
    d = S.score(m(spark, sf_dir), CAL)
    for mode, (policy, _) in EXPLAINED.items():
        d = S.decide(d, policy).withColumnRenamed("reasons", f"__{mode}").drop("decision")
    return d.select("episode", F.inline(F.array(*[F.struct(F.lit(mode).alias("mode"), F.col(f"__{mode}").alias("reasons")) for mode in EXPLAINED])))

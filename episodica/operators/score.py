"""Scores and decisions: projections over measured rows, with fits as constants."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions.numbers import fixed, general
from . import fit as T
from .measure import HARD, SOFT

#: Family weights and the order in which families are reported.
WEIGHTS = {"smoothness": 0.30, "acceleration": 0.30, "contact": 0.0, "timing": 0.25, "video": 0.15}


def _ramp(key: str, c: T.Calibration, v: Column | None = None) -> Column:
    return K.ramp(F.col(key) if v is None else v, *c.brackets[key])


def smoothness(c: T.Calibration, mode: str = "geometric") -> Column:
    term = lambda k: F.when(F.col(k).isNotNull(), _ramp(k, c))
    return K.combine({k: (term(k), w) for k, w in (("ldlj_wrist", 0.5), ("ldlj_arm", 0.3), ("ldlj_body", 0.2))}, mode)


def acceleration(c: T.Calibration, mode: str = "geometric") -> Column:
    def chain(name: str) -> Column:
        rms, p99 = f"acc_{name}_rms", f"acc_{name}_p99"
        return F.when(F.col(rms).isNotNull() | F.col(p99).isNotNull(), F.least(_ramp(rms, c), _ramp(p99, c)))

    return K.combine({n: (chain(n), 1.0) for n in ("arm", "body", "wrist")}, mode)


def contact(c: T.Calibration, mode: str = "geometric") -> Column:
    return K.decay(F.col("contact_rate_hz"), c.contact_rate_ref)


def timing(c: T.Calibration, mode: str = "geometric") -> Column:
    duration = F.lit(None).cast("double")
    if c.duration_median is not None:
        duration = K.gauss(K.robust_z(F.col("duration_s"), c.duration_median, c.duration_mad or 0.0), c.tau_fast, c.tau_slow)
    idle = F.when(F.col("idle_fraction").isNotNull(), K.ramp(F.col("idle_fraction"), 1.0, c.idle_allowance))
    ok = (F.col("grasp_transitions") >= 0) & ~F.col("grasp_incomplete")
    grasp = F.when(ok, F.exp(-F.greatest(F.lit(0), F.col("grasp_transitions") - c.grasp_nominal) / c.grasp_decay))
    return K.combine({"duration": (duration, 0.5), "idle": (idle, 0.3), "grasp": (grasp, 0.2)}, mode)


def video(c: T.Calibration, mode: str = "geometric") -> Column:
    cut = K.clip
    allowance = F.when(F.col("arm_speed_rms").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(c.sharpness_allowance_cap), F.col("arm_speed_rms") / c.sharpness_allowance_scale))).otherwise(0.0)
    sharp = cut(K.ramp(F.col("video_sharpness"), *c.sharpness_fallback) + allowance)
    if "video_sharpness_residual" in c.brackets:
        res = T.residual(c.sharpness_intercept, c.sharpness_slope)
        sharp = F.when(res.isNotNull(), _ramp("video_sharpness_residual", c, res)).otherwise(sharp)
    exposure = cut(1 - F.abs(F.col("video_brightness") - 127.5) / 127.5)
    clipping = cut(1 - F.col("video_clipped_fraction") / 0.02)
    freeze = F.when(F.col("video_interframe_diff") < 1.0, cut(F.col("video_interframe_diff"))).otherwise(1.0)
    value = F.when(clipping.isNotNull(), F.least(freeze, clipping)) * (0.45 * sharp + 0.30 * exposure + 0.25 * _ramp("video_contrast", c))
    return F.when(F.col("video_decodable").isNull(), F.lit(None)).when(~F.col("video_decodable") | F.col("video_truncated"), 0.0).otherwise(value)


FAMILIES = {"smoothness": smoothness, "acceleration": acceleration, "contact": contact, "timing": timing, "video": video}


def score(measures: DataFrame, c: T.Calibration | None = None, weights: Mapping[str, float] = WEIGHTS, mode: str = "geometric") -> DataFrame:
    """Adds a column for each family, total (0 when nothing is measurable) and severity."""
    c = c or T.Calibration()
    d = measures
    for name, fn in FAMILIES.items():
        d = d.withColumn(name, fn(c, mode))
    total = F.coalesce(K.combine({n: (F.col(n), weights.get(n, 0.0)) for n in FAMILIES}, mode), F.lit(0.0))
    return d.withColumn("total", total).withColumn("severity", -F.ln(F.greatest(F.col("total"), F.lit(1e-12))))


@dataclass(frozen=True)
class Rule:
    quantity: str
    limit: float
    op: str = ">"
    action: str = "reject"
    enabled: bool = True
    label: str = ""
    unit: str = ""

    def text(self) -> str:
        """The rule as users read it; label and unit are those of the quantity where none are given."""
        label, unit = T.RULE_TEXTS.get(self.quantity, (self.quantity, ""))
        unit = self.unit or ("" if self.label else unit)
        return f"{self.label or label} {self.op} {self.limit:g}" + (f" {unit}" if unit else "")

    def fires(self) -> Column:
        """NULL never fires."""
        v = T.rule_value(self.quantity)
        return F.coalesce(v > self.limit if self.op == ">" else v < self.limit, F.lit(False))


def parse_limits(items: Sequence[str]) -> list[Rule]:
    """``quantity>limit`` or ``quantity<limit``, with ``:action`` behind it where it isn't reject."""
    rules = []
    for item in items:
        got = re.fullmatch(r"([^<>:]+)([<>])([^:]+)(?::(.*))?", item.strip())
        if not got:
            raise ValueError(f"a limit needs '>' or '<': {item!r}")
        key = got[1].strip()
        if key not in T.RULE_SEEDS:
            raise ValueError(f"unknown quantity {key!r}; expected one of {sorted(T.RULE_SEEDS)}")
        rules.append(Rule(key, float(got[3]), got[2], got[4] or "reject"))
    return rules


def parse_weights(text: str | None) -> dict[str, float]:
    """``family=weight`` items between commas, over the default weights."""
    given = dict(item.split("=", 1) if "=" in item else (item, "") for item in filter(None, map(str.strip, (text or "").split(","))))
    given = {k.strip(): v for k, v in given.items()}
    unknown = sorted(set(given) - set(WEIGHTS))
    if unknown:
        raise ValueError(f"unknown family {unknown[0]!r}; expected one of {sorted(WEIGHTS)}")
    return WEIGHTS | {k: float(v) for k, v in given.items()}


@dataclass(frozen=True)
class Policy:
    mode: str = "gate"
    threshold: float = 0.35
    minimums: Mapping[str, float] = field(default_factory=dict)
    rules: Sequence[Rule] = ()
    limits: Sequence[Rule] = ()
    weights: Mapping[str, float] = field(default_factory=lambda: dict(WEIGHTS))
    review_on_contact: bool = True
    contact_review_hz: float = 0.5
    semantic_accept: float = 1.0
    semantic_reject: float = 0.0


def _listed(pairs: list[tuple[Column, Column]]) -> Column:
    """The texts whose condition holds, in order."""
    if not pairs:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(ok, text) for ok, text in pairs]))


def _common(columns: list[str], reject_bar: float) -> list[tuple[Column, Column]]:
    hard = _listed([(F.coalesce(F.col(f), F.lit(False)), F.lit(f"flag:{f}")) for f in HARD])
    steps = [(F.size(hard) > 0, hard)]
    if "semantic" in columns:
        note = F.when(F.col("semantic_note") != "", F.concat(F.lit(": "), F.col("semantic_note"))) if "semantic_note" in columns else F.lit(None).cast("string")
        said = F.concat(F.lit("semantic:goal not reached"), F.coalesce(note, F.lit("")))
        steps.append((F.coalesce(F.col("semantic") <= reject_bar, F.lit(False)), F.array(said)))
    return steps


def decide(scored: DataFrame, p: Policy | None = None) -> DataFrame:
    """Adds decision and reasons; each stage ends the decision with reasons of its own."""
    p, has = p or Policy(), "semantic" in scored.columns
    stages = _common(scored.columns, p.semantic_reject)
    hit = [(r.fires(), F.concat(F.lit(f"limit:{r.quantity}{r.op}{r.limit:g} (got "), general(T.rule_value(r.quantity), 3), F.lit(")"))) for r in p.limits]
    stages.insert(1, (F.size(_listed(hit)) > 0, _listed(hit)))
    review: list[tuple[Column, Column]] = []
    if p.mode == "rules":
        said = lambda r: F.concat(F.lit(f"{r.text()} (got "), general(T.rule_value(r.quantity), 4), F.lit(")"))
        active = [r for r in p.rules if r.enabled]
        out = _listed([(r.fires(), said(r)) for r in active if r.action == "reject"])
        stages.append((F.size(out) > 0, out))
        review += [(r.fires(), said(r)) for r in active if r.action != "reject"]
    elif p.mode == "gate":
        floors = {n: p.minimums.get(n, p.threshold) for n in FAMILIES}
        low = _listed([(F.coalesce(F.col(n) < f, F.lit(False)), F.concat(F.lit(f"{n} "), fixed(F.col(n), 3), F.lit(f" < {f:g}"))) for n, f in floors.items() if f > 0])
        stages.append((F.size(low) > 0, low))
    else:
        stages.append((F.col("total") < p.threshold, F.array(F.concat(F.lit("score "), fixed(F.col("total"), 3), F.lit(f" < {p.threshold:g}")))))
    review += [(F.coalesce(F.col(f), F.lit(False)), F.lit(f"flag:{f}")) for f in SOFT]
    if p.mode not in ("rules", "gate"):
        review += [(F.coalesce(F.col(n) < f, F.lit(False)), F.concat(F.lit(f"{n} "), fixed(F.col(n), 3), F.lit(f" < {f:g}"))) for n, f in p.minimums.items()]
    rate = F.concat(F.lit("("), fixed(F.col("contact_rate_hz"), 2), F.lit(" Hz)"))
    events = F.concat(F.lit("contact "), *([F.col("contact_count").cast("string"), F.lit(" events ")] if "contact_count" in scored.columns else []), rate)
    if p.review_on_contact:
        review.append((F.coalesce(F.col("contact_rate_hz") > p.contact_review_hz, F.lit(False)), events))
    if has:
        review.append((F.coalesce(F.col("semantic") < p.semantic_accept, F.lit(False)), F.concat(F.lit("semantic "), general(F.col("semantic")))))
    return _finish(scored, stages, _listed(review))


def _finish(d: DataFrame, stages: list[tuple[Column, Column]], review: Column, looked: Column | None = None) -> DataFrame:
    """looked: whether review has texts, where that can be told without them."""
    looked = F.size(review) > 0 if looked is None else looked
    decision = reasons = None
    for ok, why in stages:
        decision = F.when(ok, "reject") if decision is None else decision.when(ok, "reject")
        reasons = F.when(ok, why) if reasons is None else reasons.when(ok, why)
    decision = decision.when(looked, "review").otherwise("accept")
    reasons = reasons.when(F.size(review) > 0, review).otherwise(F.array().cast("array<string>"))
    return d.withColumn("decision", decision).withColumn("reasons", reasons)


def penalties(measures: DataFrame, p: T.Profile) -> DataFrame:
    """A row per episode and criterion: value, position, violation and cost."""
    d = T.unpivot(measures, p, p.criteria).withColumn("u", K.position(F.col("value"), F.col("good"), F.col("bad")))
    return d.withColumn("p", K.violation(F.col("u"))).withColumn("cost", K.cost(F.col("u")))


def criteria(p: T.Profile, only: Sequence[int] | None = None) -> Column:
    """An array of each enabled criterion's i (its place in the profile), value, violation p, weighted cost nats and cost.

    only: the places to judge.

    Values stand side by side, and one lambda judges them all, so the code to compile doesn't grow with their number.
    """
    active = [(i, c) for i, c in enumerate(p.criteria) if c.enabled and (only is None or i in only)]
    number = lambda v: F.lit(float(v))
    rows = [F.struct(F.lit(i).alias("i"), T.quantity(c.quantity, p).cast("double").alias("value"), number(c.good).alias("good"), number(c.bad).alias("bad"), number(c.weight).alias("weight")) for i, c in active]
    if not rows:
        return F.array().cast("array<struct<i:int,value:double,p:double,nats:double,cost:double>>")
    placed = F.transform(F.array(*rows), lambda x: F.struct(x["i"].alias("i"), x["value"].alias("value"), x["weight"].alias("weight"), K.position(x["value"], x["good"], x["bad"]).alias("u")))
    cut = F.transform(placed, lambda x: F.struct(x["i"].alias("i"), x["value"].alias("value"), x["weight"].alias("weight"), x["u"].alias("u"), K.clip(x["u"]).alias("c")))
    step = lambda c: 3 * c * c - 2 * c * c * c
    judged = F.transform(cut, lambda x: F.struct(x["i"].alias("i"), x["value"].alias("value"), x["weight"].alias("weight"), K.violation(x["u"], step(x["c"])).alias("p"), K.cost(x["u"], step(x["c"])).alias("cost")))
    return F.transform(judged, lambda x: F.struct(x["i"].alias("i"), x["value"].alias("value"), x["p"].alias("p"), (x["weight"] * x["cost"]).alias("nats"), x["cost"].alias("cost")))


def _dearest(values: Column, active: Sequence[tuple[int, T.Criterion]]) -> Column:
    """Criteria, as their places in active, by descending weighted cost to nine places, unknown ones last, equals in their order.

    They are sorted inside their row, so that no table of criteria is sorted, and by costs alone: lambdas aren't compiled, so
    what a row shows besides is left to the rows that come out.
    """
    of = lambda name, i: F.get(F.array(*[F.lit(float(getattr(c, name))) for _, c in active]).cast("array<double>"), i)
    placed = F.transform(values, lambda v, i: K.position(v, of("good", i), of("bad", i)))
    nats = F.transform(placed, lambda u, i: of("weight", i) * K.cost(u, 3 * u * u - 2 * u * u * u))
    dear = lambda n: F.when(n == 0, 0.0).when(n.isNotNull(), -F.round(n, 9)).otherwise(float("inf"))
    return F.sort_array(F.transform(nats, lambda n, i: F.struct(dear(n).alias("dear"), i.alias("i"), n.alias("nats"))))


def _by_cost(measures: DataFrame, p: T.Profile, active: Sequence[tuple[int, T.Criterion]], chosen=lambda dearest: dearest) -> DataFrame:
    """A row per episode and criterion in the order of ``_dearest``, its values beside its place."""
    values = F.array(*[T.quantity(c.quantity, p).cast("double") for _, c in active]).cast("array<double>")
    d = measures.select("episode", "valid", values.alias("__values"))
    d = d.select("episode", "valid", "__values", F.posexplode(chosen(_dearest(F.col("__values"), active))).alias("__at", "__c"))
    of = lambda name, items: F.get(F.array(*[F.lit(v) for v in items]), F.col("__c.i")).alias(name) if active else F.lit(None).alias(name)
    texts = [of(k, [getattr(c, k) for _, c in active]) for k in ("quantity", "label", "family", "unit", "action")]
    numbers = [of(k, [float(getattr(c, k)) for _, c in active]) for k in ("weight", "good", "bad")]
    d = d.select("episode", "valid", of("rank", [i for i, _ in active]), *texts, *numbers, F.get("__values", F.col("__c.i")).alias("value"), (F.col("__at") + 1).alias("place"))
    d = d.withColumn("u", K.position(F.col("value"), F.col("good"), F.col("bad")))
    return d.withColumn("p", K.violation(F.col("u"))).withColumn("cost", K.cost(F.col("u")))


def ranked(measures: DataFrame, p: T.Profile) -> DataFrame:
    """The criteria of every episode with ``place``, the dearest first; weighted costs count to nine places, ties by rank."""
    d = _by_cost(measures, p, [(i, c) for i, c in enumerate(p.criteria) if c.enabled])
    return d.select("episode", "valid", "rank", "quantity", "label", "family", "unit", "action", "weight", "good", "bad", "value", "u", "p", "cost", "place")


def _counting(p: T.Profile) -> list[int]:
    """Places of the criteria that count towards the severity."""
    return [i for i, c in enumerate(p.criteria) if c.enabled and c.action != "review" and c.weight > 0]


def absolute_columns(p: T.Profile, judged: Column | None = None) -> tuple[Column, Column]:
    """severity and total as expressions over a measured row: no row is multiplied, nothing is shuffled."""
    some = F.filter(criteria(p) if judged is None else judged, lambda x: x["i"].isin(_counting(p)) & x["nats"].isNotNull())
    severity = F.aggregate(some, F.lit(None).cast("double"), lambda a, x: F.coalesce(a, F.lit(0.0)) + x["nats"])
    return severity, F.when(severity >= 700, 0.0).otherwise(F.exp(-severity))


def score_absolute(measures: DataFrame, p: T.Profile) -> DataFrame:
    severity = absolute_columns(p)[0]
    return measures.withColumn("severity", severity).withColumn("total", F.when(F.col("severity") >= 700, 0.0).otherwise(F.exp(-F.col("severity"))))


def family_view(measures: DataFrame, p: T.Profile) -> DataFrame:
    """episode, family and exp(-weighted cost) over all measurable criteria of positive weight."""
    # a cost is unknown where the position is
    d = penalties(measures, p).where("weight > 0 and u is not null")
    return d.groupBy("episode", "family").agg(F.exp(-F.sum(F.col("weight") * F.col("cost"))).alias("score"))


def top_offenders(measures: DataFrame, p: T.Profile, k: int = 3) -> DataFrame:
    """The k dearest criteria of each episode; equals keep the criteria's order."""
    able = [(i, c) for i, c in enumerate(p.criteria) if c.enabled and c.action != "review"]
    d = _by_cost(measures, p, able, lambda dearest: F.slice(F.filter(dearest, lambda x: x["nats"] > 0), 1, k))
    return d.select("episode", "place", "quantity", "value", "p", "cost")


def decide_absolute(scored: DataFrame, p: T.Profile) -> DataFrame:
    """Adds decision and reasons; the offenders of a rejection are the dearest three, equals in the criteria's order."""
    has = "semantic" in scored.columns
    d = scored.withColumn("__criteria", criteria(p))
    texts = lambda f: F.array(*[F.lit(f(c)) for c in p.criteria]) if p.criteria else F.array(F.lit(""))
    unit = lambda c: f" {c.unit}" if c.unit else ""
    label, behind = texts(lambda c: f"{c.label or c.quantity} "), texts(lambda c: f"{unit(c)} (good {c.good:g}, bad {c.bad:g}, p=")
    dear = F.filter("__criteria", lambda x: x["i"].isin(_counting(p)) & (x["nats"] > 0))
    dear = F.slice(F.array_sort(F.transform(dear, lambda x: F.struct((-x["nats"]).alias("n"), x["i"].alias("i"), x["value"].alias("value"), x["p"].alias("p")))), 1, 3)
    top = F.transform(dear, lambda x: F.concat(F.get(label, x["i"]), general(x["value"], 4), F.get(behind, x["i"]), fixed(x["p"], 2), F.lit(")")))
    said = F.concat(F.array(F.concat(F.lit("score "), fixed(F.col("total"), 3), F.lit(f" < {p.threshold:g}"))), top)
    looked_at = [i for i, c in enumerate(p.criteria) if c.enabled and c.action == "review"]
    bad = F.filter(criteria(p, looked_at), lambda x: x["p"] > 0.5)
    noted = F.transform(bad, lambda x: F.concat(F.get(label, x["i"]), general(x["value"], 4), F.get(texts(unit), x["i"])))
    stages = _common(scored.columns, 0.0) + [(F.coalesce(F.col("total") < p.threshold, F.lit(False)), said)]
    soft = [(F.coalesce(F.col(f), F.lit(False)), F.lit(f"flag:{f}")) for f in SOFT]
    review, looked = F.concat(_listed(soft), noted), F.col("total").isNull()
    for ok, _ in soft:
        looked = looked | ok
    if has:
        low = F.coalesce(F.col("semantic") < 1, F.lit(False))
        review, looked = F.concat(review, _listed([(low, F.concat(F.lit("semantic "), general(F.col("semantic"))))])), looked | low
    unmeasured = F.array(F.lit("no criterion measurable on this episode"))
    return _finish(d, stages, F.when(F.col("total").isNull(), unmeasured).otherwise(review), looked | (F.size(bad) > 0)).drop("__criteria")

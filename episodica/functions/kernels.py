"""Numeric building blocks as Column expressions.

Not measurable is NULL here: ``clean`` turns NaN and infinities into NULL, which
aggregates skip and comparisons never fire on.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

MAD_SCALE = 1.4826
FLOOR = 0.02
P_MAX = 0.98
U_CAP = 50.0


def clean(c: Column) -> Column:
    """NULL where a value is NaN or infinite."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def gradient(x: Column, t: Column, w: WindowSpec) -> Column:
    """Second-order differences on uneven time steps, one-sided at the ends; 0 for a lone sample."""
    xb, xa, tb, ta = F.lag(x).over(w), F.lead(x).over(w), F.lag(t).over(w), F.lead(t).over(w)
    hs, hd = t - tb, ta - t
    inner = F.try_divide(-hd, hs * (hs + hd)) * xb + F.try_divide(hd - hs, hs * hd) * x + F.try_divide(hs, hd * (hs + hd)) * xa
    return F.when(tb.isNull() & ta.isNull(), F.lit(0.0)).when(tb.isNull(), F.try_divide(xa - x, hd)).when(ta.isNull(), F.try_divide(x - xb, hs)).otherwise(inner)


def slope(x: Column, t: Column, w: WindowSpec) -> Column:
    """The same as ``gradient``, from differences: exactly 0 where x stays; NULL next to NULL and for a lone sample."""
    hs, hd = t - F.lag(t).over(w), F.lead(t).over(w) - t
    left, right = F.try_divide(x - F.lag(x).over(w), hs), F.try_divide(F.lead(x).over(w) - x, hd)
    return F.when(F.lag(t).over(w).isNull(), right).when(F.lead(t).over(w).isNull(), left).otherwise(F.try_divide(hd * left + hs * right, hs + hd))


def rms(x: Column) -> Column:
    return F.sqrt(F.avg(x * x))


def spikes(x: Column, w: WindowSpec, k: float = 6.0) -> Column:
    """Whether x exceeds median + k scaled MADs of its partition (w has no order); false where the MAD is 0."""
    median = F.percentile(x, F.lit(0.5)).over(w)
    mad = F.percentile(F.abs(x - median), F.lit(0.5)).over(w)
    return F.coalesce((mad > 1e-12) & (x > median + k * MAD_SCALE * mad), F.lit(False))


def run_starts(b: Column, w: WindowSpec) -> Column:
    """True at the first row of each run of true rows."""
    return b & ~F.coalesce(F.lag(b).over(w), F.lit(False))


def hysteresis(x: Column, w: WindowSpec, threshold: float, band: float) -> Column:
    """The held state: true once under threshold - band, false once over threshold + band."""
    running = w.rowsBetween(WindowUnbounded, 0)
    crossed = F.when(x > threshold + band, F.lit(False)).when(x < threshold - band, F.lit(True))
    return F.coalesce(F.last(crossed, ignorenulls=True).over(running), F.first(x).over(running) < threshold, F.lit(False))


WindowUnbounded = -(1 << 63)


def clip(v: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Cut to [lo, hi]; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(v.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), v)))


def ramp(v: Column, lo: Column | float, hi: Column | float) -> Column:
    """(v - lo) / (hi - lo) cut to [0, 1]; 0 where not measurable or lo = hi."""
    lo, hi = _col(lo), _col(hi)
    return F.coalesce(clip(F.try_divide(v - lo, hi - lo)), F.lit(0.0))


def gauss(z: Column, fast: float = 2.0, slow: float = 1.25) -> Column:
    """exp(-(z / tau)^2), tau by the side of z."""
    return F.exp(-F.pow(z / F.when(z >= 0, F.lit(slow)).otherwise(F.lit(fast)), F.lit(2)))


def decay(v: Column, ref: float) -> Column:
    return F.when(v.isNotNull(), F.exp(-F.greatest(v, F.lit(0.0)) / ref)).otherwise(0.0) if ref > 0 else F.lit(0.0)


def robust_z(v: Column, median: Column | float, mad: Column | float) -> Column:
    return (v - _col(median)) / F.greatest(_col(mad), F.lit(1e-6))


def combine(parts: Mapping[str, tuple[Column, float]], mode: str = "geometric") -> Column:
    """Weighted mean over the measurable parts of positive weight; NULL when there are none."""
    # each part stands once in the expression, so that expressions over scores don't multiply in size
    rows = [F.struct(score.cast("double").alias("s"), F.lit(float(weight)).alias("w")) for score, weight in parts.values() if weight > 0]
    if not rows:
        return F.lit(None).cast("double")

    def add(a: Column, x: Column) -> Column:
        one = F.ln(F.greatest(x["s"], F.lit(FLOOR))) if mode == "geometric" else x["s"]
        return F.when(x["s"].isNull(), a).otherwise(F.struct((a["v"] + x["w"] * one).alias("v"), (a["w"] + x["w"]).alias("w")))

    mean = lambda a: F.try_divide(a["v"], a["w"])
    start = F.struct(F.lit(0.0).alias("v"), F.lit(0.0).alias("w"))
    return F.aggregate(F.array(*rows), start, add, (lambda a: F.exp(mean(a))) if mode == "geometric" else mean)


def smoothstep(u: Column) -> Column:
    c = clip(u)
    return 3 * c * c - 2 * c * c * c


def position(v: Column, good: Column | float, bad: Column | float) -> Column:
    """Where v lies from good (0) to bad (1); NULL when not measurable or good = bad."""
    good, bad = _col(good), _col(bad)
    return F.try_divide(v - good, bad - good)


def violation(u: Column, step: Column | None = None) -> Column:
    """step is smoothstep(u), where that is at hand."""
    step = smoothstep(u) if step is None else step
    return F.when(u <= 0, 0.0).when(u <= 1, P_MAX * step).when(u > 1, 1 - F.pow(F.lit(1 - P_MAX), F.least(u, F.lit(U_CAP))))


def cost(u: Column, step: Column | None = None) -> Column:
    """The nats of a violation."""
    step = smoothstep(u) if step is None else step
    return F.when(u <= 0, 0.0).when(u <= 1, -F.ln(F.greatest(1 - P_MAX * step, F.lit(1e-300)))).when(u > 1, F.least(u, F.lit(U_CAP)) * -math.log(1 - P_MAX))


def bin20(v: Column, bins: int = 20) -> Column:
    """Bin of [0, 1], the last one closed; NULL outside."""
    return F.when((v >= 0) & (v <= 1), F.least(F.floor(v * bins), F.lit(bins - 1)).cast("int"))


def norm(*cs: Column) -> Column:
    total = cs[0] * cs[0]
    for c in cs[1:]:
        total = total + c * c
    return F.sqrt(total)


def _col(v: Column | float) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))

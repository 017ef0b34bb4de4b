"""Numbers as texts: doubles rounded by their exact binary value, halves to even, as C prints them.

Java's formatter rounds a double's shortest decimal form half up, so that it prints
0.1525 (which is a little less) as 0.153. Here a number is scaled by a power of ten,
what the product's rounding lost is worked out as a second double, and both decide
on which side of the half the number stands. Everything is a column expression;
each intermediate value is bound by a lambda, so that the code doesn't grow.
Products of 2^53 and more, where doubles have no such digits, are left to Java.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0
#: Powers of ten up to this one are doubles without error.
_EXACT = 22


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value worked out once."""
    return F.get(F.transform(F.array(value), lambda x: then(x)), F.lit(0))


def _nearest(below: Column, over: Column) -> Column:
    return below + F.when(over > 0, 1).when(over < 0, 0).otherwise(below % 2)


def _rounded(a: Column, scale: Column) -> Column:
    """a * scale as the nearest whole number, for a >= 0, a scale without error and a product below 2^53."""

    def lost(x: Column) -> Column:
        return ((x["ah"] * x["sh"] - x["p"]) + x["ah"] * (scale - x["sh"]) + (a - x["ah"]) * x["sh"]) + (a - x["ah"]) * (scale - x["sh"])

    high = lambda v: F.lit(_SPLIT) * v - (F.lit(_SPLIT) * v - v)
    parts = F.struct((a * scale).alias("p"), high(a).alias("ah"), high(scale).alias("sh"), F.floor(a * scale).alias("below"))
    return _let(parts, lambda x: _nearest(x["below"], (x["p"] - x["below"] - F.lit(0.5)) + lost(x)))


def fixed(v: Column, digits: int) -> Column:
    """The text of v with so many digits behind the point (``%.3f``); NULL for NULL."""
    v, scale = v.cast("double"), 10**digits
    behind = lambda n: [F.lit("."), F.lpad((n % scale).cast("string"), digits, "0")] if digits else []
    # below 2^30 a product errs by less than 2^-23, so away from a half it decides by itself
    p = F.abs(v) * float(scale)
    plain = (p < 2.0**30) & (F.abs(p - F.floor(p) - 0.5) > 1e-6)
    n = F.when(plain, F.floor(p + 0.5)).otherwise(_let(_rounded(F.abs(v), F.lit(float(scale))), lambda n: n))
    text = F.concat(((n - n % scale) / scale).cast("long").cast("string"), *behind(n))
    return F.when(F.abs(v) * scale < 2.0**53, F.concat(F.when(v < 0, "-").otherwise(""), text)).when(v.isNotNull(), F.format_string(f"%.{digits}f", v))


def general(v: float | Column, digits: int = 6) -> Column:
    """The text of v with up to so many digits (``%.4g``): no zeros at the end, an exponent where the number is far from 1."""
    if not isinstance(v, Column):
        return F.lit(f"{v:.{digits}g}")
    v = v.cast("double")
    ten = lambda k: F.pow(F.lit(10.0), k.cast("double"))

    def near(x: Column) -> Column:
        """The digits of x.a from its first one on as a whole number; up is the power of ten that brings them before the point."""
        up = F.lit(digits - 1) - x["power"]
        small = _let(F.struct(x["a"].alias("a"), ten(F.least(F.greatest(up, F.lit(0)), F.lit(_EXACT))).alias("scale")), lambda y: _rounded(y["a"], y["scale"]))
        step = F.struct(x["a"].alias("a"), ten(F.greatest(-up, F.lit(0))).alias("step"))
        large = _let(step, lambda y: _let(F.floor(y["a"] / y["step"]), lambda n: _nearest(n, y["a"] - (n + F.lit(0.5)) * y["step"])))
        return F.struct(x["power"].alias("power"), F.when(up >= 0, small).otherwise(large).alias("n"))

    def carried(x: Column) -> Column:
        full = x["n"] >= 10**digits
        return F.struct(F.when(full, F.floor(x["n"] / 10)).otherwise(x["n"]).cast("string").alias("shown"), (x["power"] + F.when(full, 1).otherwise(0)).alias("power"))

    def said(x: Column) -> Column:
        shown, power = x["shown"], x["power"]
        above = F.concat(F.substring(shown, F.lit(1), power + 1), F.lit("."), F.substring(shown, power + 2, F.lit(digits)))
        plain = F.when(power >= 0, above).otherwise(F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), shown))
        mantissa = F.concat(F.substring(shown, 1, 1), F.lit("."), F.substring(shown, 2, digits))
        near_one = (power >= -4) & (power < digits)
        far = F.concat(F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
        return F.concat(F.regexp_replace(F.when(near_one, plain).otherwise(mantissa), r"\.?0*$", ""), F.when(near_one, "").otherwise(far))

    scaled = _let(F.abs(v), lambda a: F.struct(a.alias("a"), F.floor(F.log10(a)).cast("int").alias("power")))
    text = _let(_let(_let(scaled, near), carried), said)
    return F.when(v == 0, "0").otherwise(F.concat(F.when(v < 0, "-").otherwise(""), text))

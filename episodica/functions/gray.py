"""Grey images as flat row-major arrays with a height and width, as Column expressions.

Video decoding is left to a plug-in that yields such rows; see
``episodica.sources.video``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _mirror(i: Column, n: Column) -> Column:
    """Borders mirror without repeating the edge."""
    return F.when(i < 0, -i).when(i >= n, 2 * n - 2 - i).otherwise(i)


def laplacian(gray: str, height: str, width: str) -> Column:
    h, w = F.col(height), F.col(width)

    def at(r: Column, c: Column) -> Column:
        return F.get(F.col(gray), (_mirror(r, h) * w + _mirror(c, w)).cast("int"))

    def cell(v: Column, i: Column) -> Column:
        r, c = F.floor(i / w).cast("int"), (i % w).cast("int")
        return at(r - 1, c) + at(r + 1, c) + at(r, c - 1) + at(r, c + 1) - 4 * v

    return F.transform(F.col(gray), cell)


def shrink(gray: str, height: str, width: str, to: int) -> Column:
    """Bilinear at pixel centres, down to a width; narrower images stay."""
    h, w = F.col(height), F.col(width)
    rows = F.greatest(F.floor(h * to / w), F.lit(1))

    def cell(i: Column) -> Column:
        y = F.greatest(F.lit(0.0), F.least(h - 1.0, (F.floor(i / to) + 0.5) * h / rows - 0.5))
        x = F.greatest(F.lit(0.0), F.least(w - 1.0, (i % to + 0.5) * w / to - 0.5))
        y0, x0 = F.floor(y), F.floor(x)
        at = lambda r, c: F.get(F.col(gray), (F.least(r, h - 1) * w + F.least(c, w - 1)).cast("int"))
        top = at(y0, x0) * (1 - x + x0) + at(y0, x0 + 1) * (x - x0)
        low = at(y0 + 1, x0) * (1 - x + x0) + at(y0 + 1, x0 + 1) * (x - x0)
        return F.round(top * (1 - y + y0) + low * (y - y0)).cast("int")

    return F.when(w <= to, F.col(gray)).otherwise(F.transform(F.sequence(F.lit(0), (rows * to - 1).cast("int")), cell))


def mean(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)


def variance(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x) / F.size(a) - mean(a) * mean(a)


def clipped(gray: Column, low: int = 5, high: int = 250) -> Column:
    return F.size(F.filter(gray, lambda x: (x > high) | (x < low))) / F.size(gray)


def mean_abs_difference(a: Column, b: Column) -> Column:
    return mean(F.zip_with(a, b, lambda x, y: F.abs(x - y).cast("double")))


def quality_penalty(blur_variance: Column, brightness: Column, max_variance: float = 80.0, max_brightness: float = 50.0) -> Column:
    """The worse of the blur and the exposure penalty."""
    blur = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.least(blur_variance / max_variance, F.lit(1.0))))
    return F.greatest(blur, 1 - brightness / max_brightness)


def blur_score(lap: Column, most: float = 1000.0) -> Column:
    """The Laplacian's variance as a share of what counts as sharp, 1 at most."""
    return F.least(variance(lap) / most, F.lit(1.0))


def darkness_score(gray: Column, most: float = 255.0) -> Column:
    return mean(gray) / most


def contrast_score(gray: Column, most: float = 80.0) -> Column:
    """The deviation as a share of what counts as full contrast, 1 at most."""
    return F.least(F.sqrt(F.greatest(variance(gray), F.lit(0.0))) / most, F.lit(1.0))


def exposure_score(gray: str, height: str, width: str, centred: bool = True) -> Column:
    """1 less the distance of the mean from the middle of the scale, as a share of it.

    Centred: pixels weigh by a Gaussian of deviation 0.5 on a square from -1 to 1 in both directions.
    """
    h, w, middle = F.col(height), F.col(width), 127.5
    place = lambda i, n: F.when(n == 1, -1.0).otherwise(2.0 * i / F.greatest(n - 1, F.lit(1)) - 1)
    weight = lambda i: F.exp(-(F.pow(place(i % w, w), F.lit(2)) + F.pow(place(F.floor(i / w), h), F.lit(2))) / 0.5)
    if centred:
        parts = F.transform(F.col(gray), lambda v, i: F.struct((v * weight(i)).alias("v"), weight(i).alias("w")))
        zero = F.struct(F.lit(0.0).alias("v"), F.lit(0.0).alias("w"))
        level = F.aggregate(parts, zero, lambda a, x: F.struct((a["v"] + x["v"]).alias("v"), (a["w"] + x["w"]).alias("w")), lambda a: F.try_divide(a["v"], a["w"]))
    else:
        level = mean(F.col(gray))
    return F.greatest(F.lit(0.0), 1 - F.abs(level - middle) / middle)


def gaussian(size: int) -> list[float]:
    """Weights of a Gaussian of an odd width whose deviation follows from the width; widths up to 7 have binomial weights."""
    fixed = {1: [1.0], 3: [0.25, 0.5, 0.25], 5: [0.0625, 0.25, 0.375, 0.25, 0.0625], 7: [0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125]}
    if size in fixed:
        return fixed[size]
    sigma, mid = 0.3 * ((size - 1) * 0.5 - 1) + 0.8, size // 2
    w = [math.exp(-((i - mid) ** 2) / (2 * sigma * sigma)) for i in range(size)]
    return [x / sum(w) for x in w]


def blur(gray: Column, height: str, width: str, size: int) -> Column:
    """Gaussian blur of an odd width, along rows and then along columns; mirrored borders, values rounded at the end."""
    h, w, half = F.col(height), F.col(width), size // 2
    weights = list(enumerate(gaussian(size), -half))

    def fold(i: Column, n: Column) -> Column:
        period = F.greatest(2 * n - 2, F.lit(1))
        m = F.pmod(i, period)
        return F.when(n == 1, 0).otherwise(F.least(m, period - m))

    def along(a: Column, place) -> Column:
        return F.transform(a, lambda v, i: sum(F.get(a, place(i, k).cast("int")) * x for k, x in weights))

    rows = along(gray, lambda i, k: F.floor(i / w) * w + fold(i % w + k, w))
    # bound by a lambda, so that the first pass isn't written out for each weight of the second
    both = F.transform(F.array(rows), lambda a: along(a, lambda i, k: fold(F.floor(i / w) + k, h) * w + i % w))
    return F.transform(F.get(both, F.lit(0)), lambda v: F.round(v).cast("int"))


def kernel_size(strength: float, largest: int = 11) -> int:
    """The odd width for a strength from 0 (none) to 1."""
    size = int(1 + strength * (largest - 1))
    return size if size % 2 else size + 1


def adjust(gray: Column, gain: float, bias: float) -> Column:
    """Contrast and brightness, cut to 0..255."""
    return F.transform(gray, lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.round(x * gain + bias).cast("int"))))

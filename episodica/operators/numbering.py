"""Places and running sums over all episodes without one window that spans them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Binary digits that each level of ranges takes away: 4096 keys a range, 65,536 ranges a wider one.
DIGITS = (12, 16)


def before(rows: DataFrame, key: str, **counted: Column | int) -> DataFrame:
    """Adds, under each name, the sum of its whole numbers over the rows of smaller keys; a count of them with 1.

    Keys are whole numbers, unique among the rows; NULL is the least. Sums are made of
    ranges of keys and of ranges of those, each level a partial aggregation, so a window
    sorts at most 4096 keys or 65,536 ranges. The last one is over the widest ranges:
    keys up to 10^12 have 3,726. A name that the rows have is replaced; NULL counts as 0.
    """
    names = list(counted)
    numbers = {f"__n{i}": F.coalesce((v if isinstance(v, Column) else F.lit(v)).cast("long"), F.lit(0).cast("long")) for i, v in enumerate(counted.values())}
    d = rows.withColumns({"__key": F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))), **numbers})
    got = _before(d, len(names), DIGITS)
    return got.withColumns({name: F.col(f"__s{i}") for i, name in enumerate(names)}).drop("__key", *numbers, *[f"__s{i}" for i in range(len(names))])


def _before(d: DataFrame, n: int, digits: Sequence[int]) -> DataFrame:
    """d (__key, __n0, ...) with __s0, ..."""
    earlier = lambda w, i: F.coalesce(F.sum(f"__n{i}").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    if not digits:
        return d.withColumns({f"__s{i}": earlier(W.orderBy("__key"), i) for i in range(n)})
    wide = F.shiftright("__key", digits[0])
    ranges = d.groupBy(wide.alias("__key")).agg(*[F.sum(f"__n{i}").alias(f"__n{i}") for i in range(n)])
    starts = _before(ranges, n, digits[1:]).select(F.col("__key").alias("__range"), *[F.col(f"__s{i}").alias(f"__b{i}") for i in range(n)])
    w = W.partitionBy("__range").orderBy("__key")
    inside = d.withColumn("__range", wide).withColumns({f"__s{i}": earlier(w, i) for i in range(n)}).join(starts, "__range")
    return inside.withColumns({f"__s{i}": F.col(f"__s{i}") + F.col(f"__b{i}") for i in range(n)}).drop("__range", *[f"__b{i}" for i in range(n)])


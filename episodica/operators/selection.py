"""Exact percentiles in a fixed amount of memory: sketches say where to look, counts prove it."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

#: Size of a sketch: up to as many values it holds them all, beyond that about three times as many at most.
K = 8192
#: How far a bracket's ends lie from its rank, as a share of the values; about eight times a sketch's error.
MARGIN = 0.005
#: Distinct values that one task may sort; brackets of more values are narrowed first.
MOST = 1 << 20


@dataclass
class _Target:
    """The values at two ranks of one column, both within [low, high]."""

    column: str
    lo: int
    hi: int
    low: float
    high: float
    below: int
    upto: int
    found: tuple[float, float] | None = None

    def within(self) -> Column:
        v = F.col(self.column)
        return v.between(F.lit(self.low), F.lit(self.high))


def small(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few rows as a local relation: no job and no Python worker makes them."""
    fields = T.StructType.fromDDL(schema)
    columns = zip(*rows) if rows else [[]] * len(fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, to_arrow_type(f.dataType)) for f, c in zip(fields, columns)], fields.names), fields)


def dealt(df: DataFrame, per: int, *keys: str, of: DataFrame | None = None) -> DataFrame:
    """The rows dealt by keys into partitions of about ``per`` rows of ``of`` (else of the input), so that what a task does and holds doesn't grow with the table."""
    n = (df if of is None else of).count()
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(n / per)), *keys)


def _brackets(d: DataFrame, sketches: Sequence[bytes], asked: Sequence[Sequence[tuple[int, int, int]]], margin: float) -> list[list[list[float]]]:
    """For each sketch and each (n, lo, hi) asked of it: the sketch's values at both ranks of n and at the ends of a bracket around them.

    A sketch takes constant ranks alone, so sketches come back as a row of a local table; each is of a fixed size.
    """
    if not sketches:
        return []
    local = small(d.sparkSession, [tuple(sketches)], ", ".join(f"s{i} binary" for i in range(len(sketches))))
    ranks = lambda n, lo, hi: ((lo + 0.5) / n, (hi + 0.5) / n, max((lo + 0.5) / n - margin, 0.0), min((hi + 0.5) / n + margin, 1.0))
    r = local.select(*[F.kll_sketch_get_quantile_double(f"s{i}", F.array(*[F.lit(x) for a in of for x in ranks(*a)])) for i, of in enumerate(asked)]).first()
    return [[r[i][4 * j : 4 * j + 4] for j in range(len(of))] for i, of in enumerate(asked)]


def _count(d: DataFrame, open_: Sequence[_Target], ends: Sequence[tuple[float, float]]) -> None:
    """Moves each target's range to the part of it that holds its ranks, by exact counts."""
    counts = []
    for i, (t, (a, b)) in enumerate(zip(open_, ends)):
        v = F.col(t.column)
        counts += [F.count_if(c).alias(f"{k}{i}") for k, c in (("lt_a", v < a), ("le_a", v <= a), ("lt_b", v < b), ("le_b", v <= b))]
    r = d.agg(*counts).first()
    for i, (t, (a, b)) in enumerate(zip(open_, ends)):
        # an end is a value of the column, so where a rank lies beyond it, that end still closes the range
        if r[f"lt_a{i}"] > t.lo:
            t.high, t.upto = a, r[f"le_a{i}"]
        elif r[f"le_b{i}"] <= t.hi:
            t.low, t.below = b, r[f"lt_b{i}"]
        else:
            t.low, t.high, t.below, t.upto = a, b, r[f"lt_a{i}"], r[f"le_b{i}"]


def _pick(d: DataFrame, open_: Sequence[_Target]) -> None:
    """The values at both ranks of each range, from its distinct values with their counts."""
    hits = [F.when(t.within(), F.struct(F.lit(i).alias("target"), F.col(t.column).alias("v"), F.lit(t.lo - t.below).cast("long").alias("lo"), F.lit(t.hi - t.below).cast("long").alias("hi"))) for i, t in enumerate(open_)]
    counted = d.select(F.inline(F.array_compact(F.array(*hits)))).groupBy("target", "lo", "hi", "v").agg(F.count("*").alias("n"))
    so_far = F.sum("n").over(W.partitionBy("target").orderBy("v"))
    got = counted.withColumn("upto", so_far).where((F.col("upto") > F.col("lo")) & (F.col("upto") - F.col("n") <= F.col("hi"))).collect()
    for i, t in enumerate(open_):
        vs = sorted(r["v"] for r in got if r["target"] == i)
        t.found = (vs[0], vs[-1])


def _settle(d: DataFrame, targets: Mapping[tuple[str, int], _Target], open_: list[tuple[str, int]], ends: Mapping[tuple[str, int], tuple[float, float]], k: int, most: int, margin: float) -> None:
    """Counts, narrows and picks until every target has its values."""
    while open_:
        sizes = {at: targets[at].upto - targets[at].below for at in open_}
        _count(d, [targets[at] for at in open_], [ends[at] for at in open_])
        wide = []
        for at in open_:
            t = targets[at]
            if t.low == t.high:
                t.found = (t.low, t.low)
            elif most < t.upto - t.below <= sizes[at] / 2:
                wide.append(at)
        if wide:
            s = d.agg(*[F.kll_sketch_agg_double(F.when(targets[at].within(), F.col(targets[at].column)), F.lit(k)).alias(f"s{i}") for i, at in enumerate(wide)]).first()
            inside = [[(t.upto - t.below, t.lo - t.below, t.hi - t.below)] for t in (targets[at] for at in wide)]
            ends = {at: tuple(x[0][2:]) for at, x in zip(wide, _brackets(d, list(s), inside, margin))}
        ready = [targets[at] for at in open_ if at not in wide and targets[at].found is None]
        if ready:
            _pick(d, ready)
        open_ = wide


def percentiles(rows: DataFrame, wanted: Mapping[str, tuple[Column, Sequence[float]]], /, k: int = K, most: int = MOST, margin: float = MARGIN, **also: Column) -> tuple[dict[str, list[float | None]], Row]:
    """The interpolated percentiles under each name, and a row with a count ``n_<name>`` and the further aggregates.

    Equal to ``percentile``, which holds every distinct value of a column in one buffer. NULL
    and NaN are no values; without any the percentiles are None. Up to k values the
    one pass of aggregation has the result. Beyond, a second pass counts what lies beside
    brackets around the ranks, and a third one, over kept columns, sorts the distinct values inside. Brackets
    of more than ``most`` values are narrowed by further sketches first, unless equal values keep them
    wide. A bracket that misses its rank costs a pass, never the result. What comes to the driver
    is a few numbers a percentile.
    """
    names = list(wanted)
    fresh = {name: f"__v{i}" for i, name in enumerate(names)}
    # neither a sketch nor a comparison with a bound takes NaN in
    d = rows.withColumns({fresh[x]: c.cast("double") for x, (c, _) in wanted.items()})
    r = d.agg(*[F.count(F.when(~F.isnan(fresh[x]), F.col(fresh[x]))).alias(f"n_{x}") for x in names], *[F.kll_sketch_agg_double(fresh[x], F.lit(k)).alias(f"__s{x}") for x in names], *[c.alias(a) for a, c in also.items()]).first()
    targets: dict[tuple[str, int], _Target] = {}
    some = [x for x in names if r[f"n_{x}"] and wanted[x][1]]
    for x in some:
        n = r[f"n_{x}"]
        for i, q in enumerate(wanted[x][1]):
            at = (n - 1) * float(q)
            targets[x, i] = _Target(fresh[x], math.floor(at), math.ceil(at), -math.inf, math.inf, 0, n)
    asked = [[(t.upto, t.lo, t.hi) for (y, _), t in targets.items() if y == x] for x in some]
    ends = {}
    for x, looked in zip(some, _brackets(d, [r[f"__s{x}"] for x in some], asked, margin)):
        for i, (lo, hi, a, b) in enumerate(looked):
            ends[x, i] = (a, b)
            if r[f"n_{x}"] <= k:
                targets[x, i].found = (lo, hi)
    open_ = [at for at, t in targets.items() if t.found is None]
    if open_:
        # the first of the further passes keeps the columns, so that what made them runs once more, not once a pass
        d = d.select(*dict.fromkeys(targets[at].column for at in open_)).persist()
        try:
            _settle(d, targets, open_, ends, k, most, margin)
        finally:
            d.unpersist()
    out: dict[str, list[float | None]] = {x: [None] * len(wanted[x][1]) for x in names}
    for (x, i), t in targets.items():
        at = (r[f"n_{x}"] - 1) * float(wanted[x][1][i])
        lo, hi = t.found
        out[x][i] = lo if t.lo == t.hi or lo == hi else (t.hi - at) * lo + (at - t.lo) * hi
    return out, Row(**{c: r[c] for c in [*[f"n_{x}" for x in names], *also]})

"""Series for charts: decimation, spans, time base and lookups, all per episode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def time_base(t: Column, index: Column, fps: Column, t0: Column) -> Column:
    """Seconds from the start, or index / fps (50 where the rate isn't known)."""
    return F.coalesce(t - t0, index / F.when(fps > 0, fps).otherwise(50.0))


def decimate(points: DataFrame, limit: int = 3000, keys: tuple[str, ...] = ("episode",)) -> DataFrame:
    """Keeps the least and the greatest y of each of limit / 2 buckets, where a series has more than limit points.

    Columns: keys, i (from 0), t, y. A bucket without values keeps its first time with NULL.
    """
    buckets, ep = max(limit // 2, 1), W.partitionBy(*keys)
    d = points.withColumn("n", F.count("*").over(ep))
    # the last edge floor(n * b / buckets) that doesn't pass i
    b = F.floor(((F.col("i") + 1) * buckets - 1) / F.col("n")).cast("int")
    d = d.withColumn("bucket", F.when(F.col("n") <= limit, F.col("i")).otherwise(b))
    y = F.col("y")
    low, high, empty = F.struct(y, F.col("i")), F.struct(y, (-F.col("i")).alias("i")), y.isNull()
    w = W.partitionBy(*keys, "bucket")
    d = d.withColumn("lo", F.min(F.when(~empty, low)).over(w)["i"]).withColumn("hi", -F.max(F.when(~empty, high)).over(w)["i"]).withColumn("first", F.min("i").over(w))
    keep = (F.col("n") <= limit) | (F.col("i") == F.col("lo")) | (F.col("i") == F.col("hi")) | (F.col("lo").isNull() & (F.col("i") == F.col("first")))
    return d.where(keep).select(*keys, "i", F.round("t", 4).alias("t"), F.round("y", 5).alias("y"))


def spans(points: DataFrame, mask: str = "mask") -> DataFrame:
    """The runs of true rows as (start, stop), each stop moved out by the median step."""
    w = W.partitionBy("episode").orderBy("t")
    d = points.withColumn("step", F.col("t") - F.lag("t").over(w))
    d = d.withColumn("dt", F.coalesce(F.percentile("step", F.lit(0.5)).over(W.partitionBy("episode")), F.lit(0.02)))
    d = d.withColumn("run", F.sum((~F.col(mask)).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0))).where(mask)
    return d.groupBy("episode", "run").agg(F.round(F.min("t"), 4).alias("start"), F.round(F.max("t") + F.first("dt"), 4).alias("stop")).drop("run")


def sample_at(points: DataFrame, when: Column) -> DataFrame:
    """Each episode's first sample at or after a time, else its last."""
    late = F.col("t") >= when
    return points.groupBy("episode").agg(F.coalesce(F.min_by(F.when(late, F.col("y")), F.when(late, F.col("t"))), F.max_by("y", "t")).alias("y"))

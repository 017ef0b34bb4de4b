"""The queries that users run over scored episodes, and the exports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.kernels import clip
from .measure import HARD, SOFT
from .numbering import before
from .selection import percentiles, small


def counts(scored: DataFrame) -> DataFrame:
    """Episodes by decision and by raised flag: kind, name, n."""
    decisions = scored.groupBy(F.lit("decision").alias("kind"), F.col("decision").alias("name")).agg(F.count("*").alias("n"))
    flags = scored.select(F.explode(F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in HARD + SOFT]))).alias("name"))
    return decisions.unionByName(flags.groupBy(F.lit("flag").alias("kind"), "name").agg(F.count("*").alias("n")))


def distributions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """name, n, mean, p5, p50 and p95 of each column."""
    return _table(df, cols, {"mean": F.avg}, {"p5": 0.05, "p50": 0.5, "p95": 0.95}, ("name", "n", "mean", "p5", "p50", "p95"))


def _table(df: DataFrame, cols: Sequence[str], aggregates: Mapping[str, Callable], at: Mapping[str, float], shown: Sequence[str], count: str = "n") -> DataFrame:
    """A row for each column: its count, aggregates and exact percentiles; none without rows."""
    wanted = {c: (F.col(c), list(at.values())) for c in cols}
    p, r = percentiles(df, wanted, rows=F.count("*"), **{f"{k}_{c}": f(F.col(c).cast("double")) for k, f in aggregates.items() for c in cols})
    got = [{"name": c, count: r[f"n_{c}"], **{k: r[f"{k}_{c}"] for k in aggregates}, **dict(zip(at, p[c]))} for c in cols] if r["rows"] else []
    schema = ", ".join(f"{k} {'string' if k == 'name' else 'bigint' if k == count else 'double'}" for k in shown)
    return small(df.sparkSession, [tuple(x[k] for k in shown) for x in got], schema)


def severity_histogram(scored: DataFrame, bins: int = 20) -> DataFrame:
    """bin and n; the range ends at the 99th percentile, 1 at least, and what lies beyond counts in the last bin."""
    # the one column is kept, so that rows are scored once, not once a pass
    d = scored.select("severity").persist()
    try:
        (top,) = percentiles(d, {"severity": (F.col("severity"), (0.99,))})[0]["severity"]
        b = F.when(F.col("severity").isNotNull(), F.least(F.floor(clip(F.col("severity") / max(top or 0.0, 1.0)) * bins), F.lit(bins - 1))).cast("int")
        got = {r["bin"]: r["n"] for r in d.groupBy(b.alias("bin")).agg(F.count("*").alias("n")).collect()}
    finally:
        d.unpersist()
    return small(scored.sparkSession, [(i, got.get(i, 0)) for i in range(bins)], "bin int, n bigint")


def agreement(scored: DataFrame, discarded: DataFrame) -> DataFrame:
    """How rejections meet the episodes that people discarded."""
    d = scored.join(discarded.select("episode", F.lit(True).alias("out")).distinct(), "episode", "left")
    out, rejected = F.coalesce("out", F.lit(False)), F.col("decision") == "reject"
    n = lambda c: F.count(F.when(c, 1))
    return d.agg(n(out & rejected).alias("both"), n(out & ~rejected).alias("missed"), n(~out & rejected).alias("extra"), n(~out & ~rejected).alias("neither"), n(out & (F.col("decision") == "review")).alias("reviewed"))


def rule_report(measures: DataFrame, rules: Sequence) -> DataFrame:
    """Hits of each rule and the spread of its quantity, over valid episodes."""
    from .fit import rule_value

    known = {f"{i}": r for i, r in enumerate(rules)}
    also = {f"{k}_{i}": f(rule_value(r.quantity)) for i, r in known.items() for k, f in (("least", F.min), ("most", F.max))}
    hits = {f"hits_{i}": F.count_if(r.fires()) for i, r in known.items()}
    p, got = percentiles(measures.where("valid"), {i: (rule_value(r.quantity), (0.05, 0.5, 0.95)) for i, r in known.items()}, rows=F.count("*"), **hits, **also)
    out = [(r.quantity, r.op, float(r.limit), got[f"hits_{i}"], *p[i], got[f"least_{i}"], got[f"most_{i}"]) for i, r in known.items()] if got["rows"] else []
    return small(measures.sparkSession, out, "quantity string, op string, limit double, hits bigint, p5 double, p50 double, p95 double, least double, most double")


def neighbours(df: DataFrame, buckets: int = 1000) -> DataFrame:
    """Each episode's neighbours by number. Numbers are dealt into ranges of their own, so no window spans them all."""
    span = F.floor(F.col("episode") / buckets)
    w = W.partitionBy("__range").orderBy("episode")
    d = df.select("episode").distinct().withColumn("__range", span)
    ends = d.groupBy("__range").agg(F.min("episode").alias("lo"), F.max("episode").alias("hi"))
    order = W.orderBy("__range")
    ends = ends.withColumn("before", F.lag("hi").over(order)).withColumn("behind", F.lead("lo").over(order))
    d = d.withColumn("previous", F.lag("episode").over(w)).withColumn("next", F.lead("episode").over(w)).join(ends, "__range")
    return d.select("episode", F.coalesce("previous", "before").alias("previous"), F.coalesce("next", "behind").alias("next"))


def search(rows: DataFrame, text: str = "", decisions: Sequence[str] = (), cols: Sequence[str] = ("episode", "decision"), order: str | None = None, descending: bool = True) -> DataFrame:
    """Rows whose decision is among those given and whose columns hold the text; nulls sort last."""
    d = rows.where(F.col("decision").isin(*decisions)) if decisions else rows
    if text:
        d = d.where(F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in cols])).contains(text.lower()))
    return d.orderBy(F.desc_nulls_last(order) if descending else F.asc_nulls_last(order)) if order else d


def what_if(df: DataFrame, col: str, cuts: Sequence[float]) -> DataFrame:
    """For each cut, how many rows lie under it."""
    one = df.agg(*[F.count(F.when(F.col(col) < c, 1)).alias(f"c{i}") for i, c in enumerate(cuts)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(float(c)).alias("cut"), F.col(f"c{i}").alias("n")) for i, c in enumerate(cuts)])))


def quantiles(rows: DataFrame, col: str, q: int = 4, key: str = "episode") -> DataFrame:
    """Rows with the quantile of their episode's mean: interpolated edges, right-closed, equal edges merged."""
    means = rows.groupBy(key).agg(F.avg(col).alias("mean"))
    edges = sorted(set(percentiles(means, {"mean": (F.col("mean"), [i / q for i in range(q + 1)])})[0]["mean"]) - {None})
    inner = F.array(*[F.lit(e) for e in edges[1:-1]]).cast("array<double>")
    return rows.join(means.select(key, F.size(F.filter(inner, lambda e: e < F.col("mean"))).alias("quantile")), key)


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """a, b and the correlation of every pair of columns, by one aggregation."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)])))


def orphans(videos: DataFrame, data: DataFrame, key: str = "episode") -> DataFrame:
    return videos.join(data.select(key), key, "left_anti")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """name, count, mean, std (sample), min, quartiles and max."""
    aggregates = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return _table(df, cols, aggregates, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, ("name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"), "count")


def worst(df: DataFrame, n: int = 10, by: str = "severity", descending: bool = True) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by) if descending else F.asc_nulls_last(by), "episode").limit(n)


def select_episodes(df: DataFrame, spec: str, by: str = "severity") -> DataFrame:
    """``3,17`` names episodes, ``worst:5`` the worst five."""
    if spec.startswith("worst:"):
        return worst(df, int(spec[6:]), by)
    return df.where(F.col("episode").isin(*[int(x) for x in spec.split(",") if x.strip()]))


def against_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Each column less its median over the valid episodes."""
    med, _ = percentiles(df.where("valid"), {c: (F.col(c), (0.5,)) for c in cols})
    return df.select("episode", *[(F.col(c) - F.lit(med[c][0]).cast("double")).alias(c) for c in cols])


def spread(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per episode: the range and the mean of the scores it has."""
    present = F.array_compact(F.array(*[F.col(c) for c in cols]))
    return df.select("episode", (F.array_max(present) - F.array_min(present)).alias("spread"), F.when(F.size(present) > 0, F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / F.size(present)).alias("mean"))


def export_join(measures: DataFrame, scores: DataFrame) -> DataFrame:
    """Measures with scores; names that both have get a suffix."""
    clash = {c: f"{c}_score" for c in scores.columns if c in measures.columns and c != "episode"}
    return measures.join(scores.withColumnsRenamed(clash), "episode", "left")


def export_selection(scored: DataFrame, decisions: Sequence[str]) -> DataFrame:
    """One row: the sorted episodes with such decisions, and the decisions asked for."""
    ids = scored.where(F.col("decision").isin(*decisions)).agg(F.array_sort(F.collect_list("episode")).alias("episodes"))
    return ids.withColumn("decisions", F.array(*[F.lit(d) for d in decisions]))


def reindex(frames: DataFrame, good: DataFrame) -> DataFrame:
    """Frames of the good episodes with new episode, frame and global numbers; offsets come from the small episode table."""
    ids = frames.join(good.select("episode").distinct(), "episode", "left_semi").groupBy("episode").agg(F.count("*").alias("length"))
    ids = before(ids, "episode", episode_index=1, offset=F.col("length"))
    w = W.partitionBy("episode").orderBy("t", "frame_index")
    d = frames.join(ids, "episode").withColumn("frame_index", (F.row_number().over(w) - 1).cast("long"))
    return d.withColumn("index", F.col("offset") + F.col("frame_index")).drop("offset", "length")


def reindex_meta(meta: DataFrame, good: DataFrame) -> DataFrame:
    ids = before(good.select("episode").distinct(), "episode", new=1)
    return meta.join(ids, "episode").withColumn("episode", F.col("new")).drop("new")


def rebuild_splits(splits: DataFrame, good: DataFrame, compat: bool = True) -> DataFrame:
    """name and its new range. compat: the old end counts as inside and the new end is the last index."""
    ids = before(good.select("episode").distinct(), "episode", i=1)
    inside = (F.col("episode") >= F.col("start")) & ((F.col("episode") <= F.col("stop")) if compat else (F.col("episode") < F.col("stop")))
    key = ["name", "start", "stop"]
    found = ids.join(F.broadcast(splits), inside).groupBy(*key).agg(F.min("i").alias("lo"), F.max("i").alias("hi"))
    d = splits.join(found, key, "left")
    if compat:
        return d.select("name", F.concat_ws(":", F.least("stop", F.coalesce("lo", "stop")), F.greatest("start", F.coalesce("hi", "start"))).alias("range"))
    return d.select("name", F.concat_ws(":", F.coalesce("lo", F.lit(0)), F.coalesce(F.col("hi") + 1, F.lit(0))).alias("range"))


def thresholds(df: DataFrame, col: str, threshold: float) -> DataFrame:
    p, r = percentiles(df, {col: (F.col(col), (0.1, 0.25, 0.5, 0.75, 0.9))}, below=F.avg((F.col(col) < threshold).cast("double")))
    return small(df.sparkSession, [(*p[col], r["below"])], "p10 double, p25 double, p50 double, p75 double, p90 double, below double")


def named(columns: Mapping[str, Column]) -> list[Column]:
    return [c.alias(k) for k, c in columns.items()]

"""Flat rows and whole-episode documents that pages and files are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import series
from ..functions.numbers import fixed
from .fit import Profile
from .measure import HARD, SOFT
from .numbering import before
from .score import FAMILIES
from .score import criteria as judged

#: Family, name, column (or several, shown side by side), decimal places and unit of the measures that a page lists.
MEASURES = (
    ("smoothness", "LDLJ wrist", "ldlj_wrist", 2, ""), ("smoothness", "LDLJ arm", "ldlj_arm", 2, ""), ("smoothness", "LDLJ body", "ldlj_body", 2, ""),
    ("acceleration", "arm RMS", "acc_arm_rms", 3, "rad/s²"), ("acceleration", "arm p99", "acc_arm_p99", 3, "rad/s²"), ("acceleration", "body RMS", "acc_body_rms", 3, "rad/s²"),
    ("acceleration", "body p99", "acc_body_p99", 3, "rad/s²"), ("acceleration", "wrist RMS", "acc_wrist_rms", 3, "m/s²"), ("acceleration", "wrist p99", "acc_wrist_p99", 3, "m/s²"),
    ("contact", "events", "contact_count", 0, ""), ("contact", "rate", "contact_rate_hz", 3, "Hz"),
    ("contact", "impact / base / tracking", ("impact_count", "base_disturbance_count", "tracking_divergence_count"), 0, ""),
    ("contact", "min wrist separation", "min_wrist_separation_m", 3, "m"), ("contact", "max base tilt", "max_base_tilt_deg", 1, "deg"),
    ("timing", "duration", "duration_s", 2, "s"), ("timing", "idle fraction", "idle_fraction", 3, ""), ("timing", "grasp transitions", "grasp_transitions", 0, ""), ("timing", "wrist path", "eef_path_m", 3, "m"), ("timing", "working side", "side", None, ""),
    ("video", "sharpness", "video_sharpness", 1, "Laplacian var"), ("video", "brightness", "video_brightness", 1, "0-255"), ("video", "contrast", "video_contrast", 1, "std"),
    ("video", "clipped", "video_clipped_fraction", 4, "fraction"), ("video", "inter-frame diff", "video_interframe_diff", 2, "grey"),
    ("video", "frames decoded", ("video_frames_decoded", "video_frames_declared"), 0, ""),
)


def score_rows(scored: DataFrame) -> DataFrame:
    """The flat row of each scored episode, in the order of a score file; reasons joined by ``; ``.

    Families and flags that the input lacks are left out, as is ``semantic``.
    """
    have = scored.columns
    middle = [c for c in (*FAMILIES, *HARD, *SOFT) if c in have] + [c for c in ("semantic",) if c in have]
    return scored.select("episode", "total", "severity", "decision", *middle, F.concat_ws("; ", "reasons").alias("reasons"))


def _shown(c: str, kind: str, places: int | None) -> Column:
    v = F.col(c)
    if places is None:
        return F.coalesce(v, F.lit("-"))
    if c == "grasp_transitions":
        v = F.when(v >= 0, v)
    whole = kind in ("int", "bigint", "smallint")
    text = v.cast("string") if whole else fixed(v, places)
    return F.when(v.isNull() | (F.lit(False) if whole else F.isnan(v)), "-").otherwise(text)


def measure_list(measures: DataFrame) -> Column:
    """An array with an episode's rows of ``measure_table``, by place."""
    kinds = dict(measures.dtypes)
    text = lambda cs, places: F.concat_ws(" / ", *[_shown(c, kinds[c], places) for c in cs])
    rows = [
        F.struct(F.lit(i).alias("place"), F.lit(family).alias("family"), F.lit(name).alias("name"), text(cs, places).alias("value"), F.lit(unit).alias("unit"))
        for i, (family, name, c, places, unit) in enumerate(MEASURES)
        if set(cs := (c,) if isinstance(c, str) else c) <= set(kinds)
    ]
    return F.array(*rows)


def measure_table(measures: DataFrame) -> DataFrame:
    """episode, place, family, name, value (text, ``-`` where not measured) and unit; rows whose columns the input lacks are left out."""
    return measures.select("episode", F.inline(measure_list(measures)))


def criteria_list(p: Profile) -> Column:
    """An array of an episode's criteria as worst (minus the violation), quantity, value and p, the worst first."""
    name = F.array(*[F.lit(c.quantity) for c in p.criteria]) if p.criteria else F.array().cast("array<string>")
    shown = lambda x: F.struct((-F.coalesce(x["p"], F.lit(-1.0))).alias("worst"), F.get(name, x["i"]).alias("quantity"), x["value"].alias("value"), x["p"].alias("p"))
    return F.sort_array(F.transform(judged(p), shown))


def axis(low: Column, high: Column, reference: Column) -> tuple[Column, Column]:
    """The ends of a track's axis: zero and the reference lie inside it, and it is never empty."""
    lo = F.least(F.lit(0.0), F.coalesce(low, F.lit(0.0)))
    hi = F.greatest(F.coalesce(high, F.lit(1.0)), reference)
    return lo, F.when(hi - lo < 1e-9, lo + 1).otherwise(hi)


def tracks(points: DataFrame, limit: int = 3000) -> DataFrame:
    """A row per (episode, key): its least and greatest value, axis and at most about ``limit`` points.

    Columns of points: episode, key, i (from 0), t, y, reference (NULL without one). A
    track's points end up in one row, hence the limit.
    """
    keys = ("episode", "key")
    ends = points.groupBy(*keys).agg(F.min("y").alias("low"), F.max("y").alias("high"), F.max("reference").alias("reference"))
    kept = series.decimate(points, limit, keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "t", "y"))).alias("p"))
    lo, hi = axis(F.col("low"), F.col("high"), F.col("reference"))
    d = ends.join(kept, [*keys]).withColumns({"lo": lo, "hi": hi})
    return d.select(*keys, F.coalesce(F.round("low", 5), F.lit(0.0)).alias("min"), F.coalesce(F.round("high", 5), F.lit(1.0)).alias("max"), "reference", "lo", "hi", F.col("p.t").alias("t"), F.col("p.y").alias("y"))


def episode_detail(scored: DataFrame, traces: DataFrame, contact: DataFrame, idle: DataFrame, criteria: DataFrame | Profile | None = None, videos: DataFrame | None = None, discarded: DataFrame | None = None) -> DataFrame:
    """A row per scored episode with everything that its page shows.

    traces as from ``tracks``; contact and idle as from ``series.spans``; criteria with
    episode, quantity, value and p, or the profile to judge by; videos with episode, camera and path.
    What is listed beside the scored rows is hashed for them to pass by; measures, and the criteria of a
    profile, become lists inside the row behind those joins. So no wide row is sorted or moved.
    """

    def listed(d: DataFrame, order: Sequence[str], name: str) -> DataFrame:
        rest = [c for c in d.columns if c != "episode" and c not in order]
        return d.groupBy("episode").agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))

    flags = [c for c in (*HARD, *SOFT) if c in scored.columns]
    families = [c for c in FAMILIES if c in scored.columns]
    page = [
        "episode", F.coalesce(F.round("duration_s", 3), F.lit(0.0)).alias("duration"), *[F.col(c) for c in ("n_frames",) if c in scored.columns], *[F.round("fps", 3).alias("fps") for _ in (0,) if "fps" in scored.columns],
        F.struct(*flags).alias("flags"), F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags])).alias("raised"),
        F.struct(F.round("total", 4).alias("total"), "decision", "reasons", F.struct(*[F.round(f, 4).alias(f) for f in families]).alias("families")).alias("score"), "severity",
    ]
    parts = [listed(traces, ["key"], "tracks"), listed(contact, ["start"], "contact"), listed(idle, ["start"], "idle")]
    if isinstance(criteria, DataFrame):
        ranked = criteria.withColumn("worst", -F.coalesce("p", F.lit(-1.0)))
        parts.append(listed(ranked, ["worst", "quantity"], "criteria"))
    if videos is not None:
        parts.append(listed(videos, ["camera"], "videos"))
    lists = {c: kind for p in parts for c, kind in p.dtypes if c != "episode"}
    if discarded is not None:
        parts.append(discarded.select("episode", F.lit(True).alias("discarded")).distinct())
    d = scored
    for p in parts:
        # a list may have the name of a family
        d = d.join(p.select("episode", *[F.col(c).alias(f"__{c}") for c in p.columns if c != "episode"]).hint("shuffle_hash"), "episode", "left")
    own = {"measures": measure_list(scored)} | ({"criteria": criteria_list(criteria)} if isinstance(criteria, Profile) else {})
    got = own | {c: F.coalesce(F.col(f"__{c}"), F.array().cast(kind)) for c, kind in lists.items()}
    names = [c for c in ("measures", "tracks", "contact", "idle", "criteria", "videos") if c in got]
    return d.select(*page, *[got[c].alias(c) for c in names], *([F.coalesce("__discarded", F.lit(False)).alias("discarded")] if discarded is not None else []))


def by_episode(frames: DataFrame, known: DataFrame | None = None, default: str | None = None) -> DataFrame:
    """A row per episode: its first place, length, states as (t, q, other channels), actions and task.

    known: task_index and task. Frames are in the order of t, then frame_index; an episode's
    frames meet in one row, as a scorer of one episode wants them.
    """
    others = [c for c in ("eef", "gravity", "left_hand", "right_hand") if c in frames.columns]
    state = F.struct("t", "frame_index", F.col("state").alias("q"), *others, F.col("action").alias("__a"))
    aggs = [F.count("*").alias("length"), F.array_sort(F.collect_list(state)).alias("s")]
    if "task_index" in frames.columns:
        aggs.append(F.min_by("task_index", F.struct("t", "frame_index")).alias("task_index"))
    d = frames.groupBy("episode").agg(*aggs)
    starts = before(frames.groupBy("episode").agg(F.count("*").alias("length")), "episode", start=F.col("length")).select(F.col("episode").alias("__e"), "start")
    d = d.join(starts, F.col("episode").eqNullSafe(F.col("__e"))).drop("__e")
    d = d.withColumn("actions", F.col("s.__a")).withColumn("states", F.transform("s", lambda x: x.dropFields("__a", "frame_index"))).drop("s")
    if known is not None:
        d = d.join(F.broadcast(known.select("task_index", "task")), "task_index", "left").withColumn("task", F.coalesce("task", F.lit(default)))
    return d


def eval_split(good: DataFrame, share: float = 1.0) -> DataFrame:
    """episode and new number of the first share of good episodes: what the full and the filtered dataset are evaluated on."""
    n = good.select("episode").distinct().count()
    d = before(good.select("episode").distinct(), "episode", filtered=1)
    return d.where(F.col("filtered") < int(share * n))


def pick(rows: DataFrame, quantile: int, n: int = 3, how: str = "lowest", key: str = "episode", seed: int = 42) -> DataFrame:
    """All rows of n episodes of a quantile: those of the least numbers, or a seeded choice that partitioning can't change."""
    if how not in ("lowest", "random"):
        raise ValueError(f"how is 'lowest' or 'random', not {how!r}")
    d = rows.where(F.col("quantile") == quantile)
    order = F.col(key) if how == "lowest" else F.xxhash64(F.lit(seed), F.col(key))
    return d.join(d.select(key).distinct().orderBy(order, key).limit(n), key, "left_semi")


def unreadable(segments: DataFrame, decoded: DataFrame) -> DataFrame:
    """Clips of which no frame was decoded."""
    return segments.join(decoded.select("episode", "camera").distinct(), ["episode", "camera"], "left_anti")

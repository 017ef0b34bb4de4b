"""A copy of a dataset folder with seeded faults: blurred and relit clips, noisy states and actions, and a log of both.

What is hit depends on the seed and on file names, episodes and frames alone, so a task
that runs again writes the same. Clips are read and written by a plug-in inside tasks.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import gray
from ..operators import inject
from . import datasets
from .rewrite import Copy, Folder, copy_file, place_file

#: A clip's path to its frames a second (0 if it doesn't say) and its frames: uint8, height x width or height x width x 3.
Decode = Callable[[str], tuple[float, Iterable[np.ndarray]]]
#: Writes such frames to a path.
Encode = Callable[[str, float, Iterable[np.ndarray]], None]

#: Noise, strength and the rate of a clip that doesn't say its own.
STRENGTH, SIGMA_STATE, SIGMA_ACTION, FPS = 0.7, 0.05, 0.03, 30.0
#: The log's remark on them.
TYPES = {
    "video_corruption_strength": STRENGTH, "state_noise_scale": SIGMA_STATE, "action_noise_scale": SIGMA_ACTION,
    "timestep_corruption": {"base_rate": 0.2, "max_additional": 0.6, "description": "For corrupted episodes, 20-80% of timesteps are corrupted"},
}
CHANNELS = ("observation.state", "action")


def blurred(frame: np.ndarray, size: int) -> np.ndarray:
    """Gaussian blur of each channel with mirrored borders, rounded; size is odd."""
    if size <= 1:
        return frame
    half = size // 2
    weights = gray.gaussian(size)
    x = frame.astype(np.float64)
    for axis in (0, 1):
        n = x.shape[axis]
        at = np.arange(-half, n + half)
        # borders mirror without repeating the edge, as often as a narrow image needs
        period = max(2 * n - 2, 1)
        at = np.abs((at + n - 1) % period - (n - 1)) if n > 1 else np.zeros_like(at)
        wide = np.take(x, at, axis=axis)
        x = sum(w * np.take(wide, np.arange(i, i + n), axis=axis) for i, w in enumerate(weights))
    return np.floor(x + 0.5).astype(np.uint8)


def faulty(frames: Iterable[np.ndarray], name: str, seed: int, strength: float) -> Iterator[np.ndarray]:
    """Blurs each frame and shifts its brightness and contrast by a draw of its own."""
    size = gray.kernel_size(strength)
    for i, frame in enumerate(frames):
        draw = np.random.default_rng([seed & 0xFFFFFFFF, zlib.crc32(name.encode()), i])
        brightness, contrast = strength * draw.uniform(-50, 50), 1 + strength * draw.uniform(-0.5, 0.5)
        yield np.clip(blurred(frame, size).astype(np.float32) * contrast + brightness, 0, 255).astype(np.uint8) if strength > 0 else frame


def rewrite_clips(clips: DataFrame, decode: Decode, encode: Encode, seed: int = 42, strength: float = STRENGTH, copy: Copy = copy_file) -> int:
    """Of (name, source, target, hit): hit clips are decoded and encoded anew frame by frame, the others copied. Counts them.

    A clip is encoded under a name of its own and then moved into place, so a task that is
    lost or runs twice leaves one whole file.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                if not r.hit:
                    copy(r.source, r.target)
                    continue

                def write(at: str, r=r) -> None:
                    fps, frames = decode(r.source)
                    encode(at, float(fps) if fps and fps > 0 else FPS, faulty(frames, r.name, seed, strength))

                place_file(r.target, write)
            yield pd.DataFrame({"n": [len(b)]})

    return clips.select("name", "source", "target", "hit").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _below(root: str, path: Column) -> Column:
    """A path's part below the root; one slash stands behind a scheme."""
    one = lambda c: F.regexp_replace(c, "^([a-z0-9]+:)/+", "$1/")
    return one(path).substr(F.length(one(F.lit(root))) + 2, F.length(path))


def files(spark: SparkSession, folder: Folder) -> DataFrame:
    """The name below the folder of each file in it; contents aren't read."""
    root = folder.qualified()
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder.root).select(_below(root, F.col("path")).alias("name"))


def _noisy(vector: Column, sigma: float, seed: int) -> Column:
    """Each value of a frame's vector with a draw of its own."""
    return F.transform(vector.cast("array<double>"), lambda x, i: x + sigma * inject.normal(seed, F.col("__episode"), F.col("__at"), i))


def noisy_frames(spark: SparkSession, folder: Folder, probability: float, seed: int) -> DataFrame | None:
    """All columns of all episode files with noise on states and actions; None where one of them is missing.

    Adds ``__name`` (the file below the folder), ``__episode``, ``__at`` (its place in the file) and whether state and action were hit.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "episode_*.parquet").option("mergeSchema", True).parquet(f"{folder.root}/data")
    if not set(CHANNELS) <= set(raw.columns):
        return None
    order = next((c for c in ("frame_index", "timestamp", "index") if c in raw.columns), None)
    d = raw.withColumns({"__name": _below(folder.qualified(), F.col("_metadata.file_path")), "__episode": datasets.episode_number(F.col("_metadata.file_name")).cast("long")})
    w = W.partitionBy("__name").orderBy(F.col(order) if order else F.lit(0))
    d = d.withColumn("__at", F.row_number().over(w).cast("long") - 1)
    for k, (c, sigma) in enumerate(zip(CHANNELS, (SIGMA_STATE, SIGMA_ACTION))):
        hit = inject.frame_hit(F.col("__episode"), F.col("__at"), probability, seed, k)
        d = d.withColumns({f"__hit{k}": hit, c: F.when(hit, _noisy(F.col(f"`{c}`"), sigma, seed + 6 + 2 * k)).otherwise(F.col(f"`{c}`").cast("array<double>"))})
    return inject.single_precision(d)


def corrupt_dataset(spark: SparkSession, root: str, out: str, probability: float = 0.5, decode: Decode | None = None, encode: Encode | None = None, seed: int = 42, overwrite: bool = True, copy: Copy = copy_file) -> DataFrame:
    """Writes the folder and its ``corruption_log.json``; gives a row per episode: episode, video, state, action (what was hit).

    Each mp4 clip is hit by a draw of its own; an episode's clips count as hit if one is. An episode's motion is hit by
    a draw, then each of its frames' state and action by draws of their own. Files without an
    episode's number keep their motion. Errors: a probability outside [0, 1], the same
    folder twice, a folder that exists without ``overwrite``, and clips without a plug-in.
    """
    if not 0 <= probability <= 1:
        raise ValueError(f"probability is from 0 to 1, not {probability}")
    source, target = Folder(spark, root), Folder(spark, out)
    if source.qualified() == target.qualified():
        raise ValueError(f"input and output are the same folder: {root}")
    if target.exists() and not overwrite:
        raise FileExistsError(f"{out} exists and overwrite is off")

    listed = files(spark, source)
    clip = F.col("name").startswith("videos/") & F.col("name").endswith(".mp4")
    d = listed.select("name", F.concat(F.lit(f"{source.qualified()}/"), "name").alias("source"), F.concat(F.lit(f"{target.qualified()}/"), "name").alias("target"), (clip & (inject.uniform(seed, F.col("name")) < probability)).alias("hit"))
    clips = d.where(clip).select(F.regexp_extract("name", r"episode_(\d+)\.", 1).try_cast("long").alias("episode"), "hit")
    if (decode is None or encode is None) and not d.where("hit").isEmpty():
        raise ValueError("clips are hit, but nothing decodes or encodes them")
    if target.exists():
        target.remove()

    frames = noisy_frames(spark, source, probability, seed)
    motion = F.col("name").startswith("data/") & F.element_at(F.split("name", "/"), -1).rlike(r"^episode_.*\.parquet$")
    rest = d if frames is None else d.where(~motion)
    rewrite_clips(rest.repartition(4 * spark.sparkContext.defaultParallelism), decode, encode, seed, STRENGTH, copy)
    if frames is not None:
        staged = frames.repartition("__name").sortWithinPartitions("__name", "__at").drop("__episode", "__at", "__hit0", "__hit1")
        staged.write.option("compression", "zstd").option("maxRecordsPerFile", 0).partitionBy("__name").parquet(f"{out}/_data")
        for at in target.parts("_data"):
            target.rename(at, unquote(at.split("__name=")[1].split("/")[0]))
        target.remove("_data")

    video = clips.where("episode is not null").groupBy("episode").agg(F.max("hit").alias("video"))
    if frames is None:
        found = video.withColumns({"state": F.lit(False), "action": F.lit(False)})
    else:
        moved = frames.groupBy(F.col("__episode").alias("episode")).agg(F.max("__hit0").alias("state"), F.max("__hit1").alias("action")).where("episode is not null")
        found = video.join(moved, "episode", "full")
    found = found.select("episode", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("video", "state", "action")])
    target.put_lines(log_lines(found, probability), "corruption_log.json", f"_log-{uuid.uuid4().hex}")
    return found


def log_lines(found: DataFrame, probability: float) -> DataFrame:
    """The log as the lines of one JSON document, an episode a line, in the order of their numbers."""
    n, last = found.agg(F.count("*"), F.max("episode")).first()
    head = json.dumps({"corruption_probability": probability, "total_episodes": n, "corruption_types": TYPES})[:-1] + ', "corrupted_episodes": {'
    names = ("video", "state", "action")
    body = F.concat(F.lit('"'), F.col("episode").cast("string"), F.lit('": '), F.to_json(F.struct(*[F.col(c).alias(f"{c}_corrupted") for c in names])), F.when(F.col("episode") < F.lit(last), ",").otherwise(""))
    ends = found.sparkSession.createDataFrame([(0, head), (2, "}}")], "part int, value string").withColumn("episode", F.lit(None).cast("long"))
    lines = found.select(F.lit(1).alias("part"), body.alias("value"), F.col("episode").cast("long").alias("episode")).unionByName(ends)
    return lines.orderBy("part", "episode").select("value")

"""Seeded faults for tests: which rows are hit depends on keys alone, not on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import gray


def uniform(seed: int, *keys: Column) -> Column:
    """In [0, 1), the same for the same keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 53)) / float(1 << 53)


def normal(seed: int, *keys: Column) -> Column:
    return F.sqrt(-2 * F.ln(1 - uniform(seed, *keys))) * F.cos(2 * math.pi * uniform(seed + 1, *keys))


def frame_hit(episode: Column, frame: Column, probability: float, seed: int, channel: int) -> Column:
    """Whether noise hits a frame's channel: a draw picks the episode, one its share (20 to 80 %), one each frame and channel."""
    share = 0.2 + 0.6 * uniform(seed + 2, episode)
    return (uniform(seed, episode) < probability) & (uniform(seed + 4 + 100 * channel, episode, frame) < share)


def motion_noise(samples: DataFrame, probability: float = 0.5, seed: int = 7, sigma_state: float = 0.05, sigma_action: float = 0.03) -> DataFrame:
    """Noise on frames of some episodes, states and actions by draws of their own; adds whether either was hit, and which."""
    key = (F.col("episode"), F.col("frame_index"), F.col("joint"))
    d = samples.withColumns({f"corrupted_{c}": frame_hit(*key[:2], probability, seed, k) for k, c in enumerate(("state", "action"))})
    d = d.withColumn("corrupted", F.col("corrupted_state") | F.col("corrupted_action"))
    d = d.withColumn("q", F.when(F.col("corrupted_state"), F.col("q") + sigma_state * normal(seed + 6, *key)).otherwise(F.col("q")))
    return d.withColumn("command", F.when(F.col("corrupted_action"), F.col("command") + sigma_action * normal(seed + 8, *key)).otherwise(F.col("command")))


def image_faults(frames: DataFrame, strength: float = 0.5, probability: float = 0.5, seed: int = 11) -> DataFrame:
    """Blurs grey frames of some clips and shifts brightness and contrast, each frame by its own draw; adds whether the clip was hit.

    Columns: episode, camera, frame_index, height, width, gray, as from ``sources.video.decode``.
    """
    clip, frame = (F.col("episode"), F.col("camera")), (F.col("episode"), F.col("camera"), F.col("frame_index"))
    d = frames.withColumn("corrupted", (uniform(seed, *clip) < probability) & F.lit(strength > 0))
    size = gray.kernel_size(strength)
    d = d.withColumn("__b", gray.blur(F.col("gray"), "height", "width", size) if size > 1 else F.col("gray"))
    gain = 1 + strength * (uniform(seed + 1, *frame) - 0.5)
    bias = strength * (100 * uniform(seed + 2, *frame) - 50)
    d = d.withColumns({"__gain": gain, "__bias": bias})
    lit = F.transform("__b", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(x * F.col("__gain") + F.col("__bias")).cast("int"))))
    return d.withColumn("gray", F.when(F.col("corrupted"), lit).otherwise(F.col("gray"))).drop("__b", "__gain", "__bias")


def single_precision(frames: DataFrame, columns: tuple[str, ...] = ("observation.state", "action")) -> DataFrame:
    """Vectors as arrays of floats, as such files hold them; columns that are missing are left out."""
    return frames.withColumns({c: F.col(f"`{c}`").cast("array<float>") for c in columns if c in frames.columns})


def log(samples: DataFrame) -> DataFrame:
    """One row: episodes in all and those with a corrupted row."""
    per = samples.groupBy("episode").agg(F.max("corrupted").alias("hit"))
    return per.agg(F.count("*").alias("total_episodes"), F.count(F.when(F.col("hit"), 1)).alias("corrupted_episodes"))

"""Video decoding as a plug-in: no codec is needed until one is given."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rewrite import file_system

FRAME = "episode long, camera string, frame_index int, declared int, height int, width int, gray array<int>"
Decoder = Callable[[str, float | None, float | None], Iterable[tuple[int, int, int, int, list[int]]]]


def decode(segments: DataFrame, decoder: Decoder) -> DataFrame:
    """Grey frames of (episode, camera, path, from_s, to_s); the decoder yields (index, declared, height, width, pixels)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                rows = [(r.episode, r.camera, *frame) for frame in decoder(r.path, r.from_s, r.to_s)]
                yield pd.DataFrame(rows, columns=["episode", "camera", "frame_index", "declared", "height", "width", "gray"])

    return segments.select("episode", "camera", "path", "from_s", "to_s").mapInPandas(run, FRAME)


RUN = 16
#: A run of neighbouring frames, as sums; ``first`` and ``last`` are its outer frames, shrunk.
FRAMES = "episode long, camera string, at long, declared long, n long, diffs long, diff double, sampled long, sharpness double, brightness double, contrast double, clipped double, first binary, last binary"


def shrunk(image: np.ndarray, to: int) -> np.ndarray:
    """Bilinear at pixel centres, down to a width; narrower images stay. The rule is that of ``gray.shrink``."""
    h, w = image.shape
    if w <= to:
        return image.astype(np.float64)
    rows = max(h * to // w, 1)
    place = lambda n, size: np.clip((np.arange(n) + 0.5) * size / n - 0.5, 0.0, size - 1.0)
    y, x = place(rows, h), place(to, w)
    y0, x0 = y.astype(int), x.astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    near = lambda r, c: image[np.ix_(np.minimum(r, h - 1), np.minimum(c, w - 1))].astype(np.float64)
    top = near(y0, x0) * (1 - fx) + near(y0, x0 + 1) * fx
    low = near(y0 + 1, x0) * (1 - fx) + near(y0 + 1, x0 + 1) * fx
    return np.floor(top * (1 - fy) + low * fy + 0.5)


def appearance(image: np.ndarray) -> tuple[float, float, float, float]:
    """Variance of the Laplacian (mirrored borders), mean, deviation, and the share of pixels at either end."""
    x = image.astype(np.float64)
    pad = lambda n: np.abs(np.r_[-1, np.arange(n), n]) if n < 2 else np.r_[1, np.arange(n), n - 2]
    rows, cols = (pad(n) if n > 1 else np.zeros(3, int) for n in x.shape)
    up, down, left, right = x[rows[:-2]], x[rows[2:]], x[:, cols[:-2]], x[:, cols[2:]]
    edges = up + down + left + right - 4 * x
    return float(edges.var()), float(x.mean()), float(x.std()), float(((x > 250) | (x < 5)).mean())


def fold(segments: DataFrame, decoder: Decoder, width: int, samples: int, every: int = 25, frames: int = 1024) -> DataFrame:
    """Rows of FRAMES: what ``measure.video_of`` needs of each clip, worked out where it is decoded.

    A task keeps RUN frames at a time and gives away a few sums for each such run,
    with the run's outer frames at ``width`` pixels, ``frames`` frames a batch.
    A clip may be given as several segments, cut anywhere: the differences across
    their borders are made from those outer frames. ``frame_index`` counts from the
    clip's beginning, so that every step-th frame is the same however it is cut.
    """

    def sums(r, run: list[tuple[int, int, np.ndarray]]) -> tuple:
        declared = max(d for _, d, _ in run)
        step = max(declared // samples, 1) if declared > 0 else every
        small = [shrunk(g, width) for _, _, g in run]
        diffs = [float(np.abs(a - b).mean()) for a, b in pairwise(small) if a.shape == b.shape]
        looks = [appearance(g) for i, _, g in run if i % step == 0]
        parts = [float(sum(x)) for x in zip(*looks, strict=True)] or [0.0] * 4
        outer = (small[0].astype("<f8").tobytes(), small[-1].astype("<f8").tobytes())
        return (r.episode, r.camera, run[0][0], declared, len(run), len(diffs), sum(diffs), len(looks), *parts, *outer)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in FRAMES.split(", ")]
        for batch in batches:
            for r in batch.itertuples():
                held, rows = [], []
                for index, declared, height, wide, pixels in decoder(r.path, r.from_s, r.to_s):
                    held.append((index, declared, np.asarray(pixels, dtype=np.uint8).reshape(height, wide)))
                    if len(held) == RUN:
                        rows.append(sums(r, held))
                        held = []
                    if len(rows) * RUN >= frames:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if held:
                    rows.append(sums(r, held))
                yield pd.DataFrame(rows, columns=names)

    return segments.select("episode", "camera", "path", "from_s", "to_s").mapInPandas(run, FRAMES)


def boxes(f: BinaryIO, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Kind, beginning and end of the content of each box between two places of an MP4 file; reads their heads alone, stops at a damaged one."""
    while start + 8 <= end:
        f.seek(start)
        head = f.read(16)
        if len(head) < 8:
            return
        size, kind, skip = int.from_bytes(head[:4]), head[4:8], 8
        if size == 1:
            size, skip = int.from_bytes(head[8:16]), 16
        elif size == 0:
            size = end - start
        if size < skip or start + size > end:
            return
        yield kind, start + skip, start + size
        start += size


def clip_header(f: BinaryIO, size: int) -> tuple[float | None, int | None]:
    """Seconds and frames of a clip's first video track, from its header boxes; None for what they don't tell.

    The track's own duration counts, else that of the file, else that of its fragments.
    """

    def inside(at: tuple[int, int] | None, *path: bytes) -> tuple[int, int] | None:
        for want in path:
            at = at and next(((b, e) for kind, b, e in boxes(f, *at) if kind == want), None)
        return at

    def number(at: int, n: int) -> int:
        f.seek(at)
        return int.from_bytes(f.read(n))

    def timed(at: tuple[int, int] | None) -> tuple[int, int]:
        """Ticks a second and ticks of a mvhd or mdhd box; all ones stand for an unknown duration."""
        if at is None:
            return 0, 0
        wide = number(at[0], 1) == 1
        skip, width = (20, 8) if wide else (12, 4)
        ticks = number(at[0] + skip + 4, width)
        return number(at[0] + skip, 4), 0 if ticks == (1 << 8 * width) - 1 else ticks

    moov = inside((0, size), b"moov")
    if moov is None:
        return None, None
    for kind, b, e in boxes(f, *moov):
        handler = inside((b, e), b"mdia", b"hdlr") if kind == b"trak" else None
        if handler and number(handler[0] + 8, 4).to_bytes(4) == b"vide":
            track = (b, e)
            break
    else:
        return None, None
    whole = timed(inside(moov, b"mvhd"))
    pieces = inside(moov, b"mvex", b"mehd")
    long = number(pieces[0] + 4, 8 if number(pieces[0], 1) == 1 else 4) if pieces else 0
    spans = [timed(inside(track, b"mdia", b"mdhd")), whole, (whole[0], long)]
    seconds = next((ticks / scale for scale, ticks in spans if scale > 0 and ticks > 0), None)
    table = inside(track, b"mdia", b"minf", b"stbl")
    sizes = inside(table, b"stsz") or inside(table, b"stz2")
    return seconds, (number(sizes[0] + 8, 4) or None) if sizes else None


def headers(clips: DataFrame) -> DataFrame:
    """path, duration_s and n_frames of each clip, by reads of a few bytes in tasks; NULL where a clip is damaged, missing or no MP4."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    system, at = file_system(path)
                    with system.open_input_file(at) as f:
                        rows.append((path, *clip_header(f, f.size())))
                except OSError:
                    rows.append((path, None, None))
            found = pd.DataFrame(rows, columns=["path", "duration_s", "n_frames"])
            yield found.astype({"duration_s": "float64", "n_frames": "Int64"})

    return clips.where("path is not null").select("path").distinct().mapInPandas(run, "path string, duration_s double, n_frames long").withColumn("duration_s", F.nanvl("duration_s", F.lit(None).cast("double")))


def with_ends(segments: DataFrame, root: str | None = None) -> DataFrame:
    """Segments (path, from_s, to_s) with ``to_s`` from the clip itself where it is NULL, with its duration_s and n_frames; paths may be below ``root``."""
    d = segments.withColumn("__path", F.concat(F.lit(f"{root}/"), "path") if root else F.col("path"))
    found = headers(d.select(F.col("__path").alias("path"))).withColumnRenamed("path", "__path")
    return d.join(found, "__path", "left").withColumn("to_s", F.coalesce("to_s", "duration_s")).drop("__path")

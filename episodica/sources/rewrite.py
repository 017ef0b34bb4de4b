"""A folder of the good episodes alone, numbered anew, in the layout that ``datasets`` reads.

    data/chunk-000/episode_000000.parquet      videos/chunk-000/<camera>/episode_000000.mp4
    meta/info.json, tasks.jsonl, episodes.jsonl, episodes_stats.jsonl

Frames and metadata are written by Spark into a staging folder; the finished files
are then renamed, so a lost executor leaves no half-written episode. Clips are
copied by tasks. The driver holds names and numbers of files, never their rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..operators import report
from ..operators.numbering import before
from . import datasets

Copy = Callable[[str, str], None]


def file_system(at: str):
    """Arrow's file system of a path or URI, and the path in it; for use in tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(at) if "://" in at or at.startswith("file:") else (fs.LocalFileSystem(), at)


def copy_file(source: str, target: str) -> None:
    """Streams one file between any two file systems that Arrow knows."""
    from pyarrow import fs

    to, path = file_system(target)
    to.create_dir(path.rsplit("/", 1)[0], recursive=True)
    fs.copy_files(source, target)


def place_file(target: str, write: Callable[[str], None]) -> None:
    """Writes a file beside the target and moves it there, whole; a failed write leaves nothing."""
    from pyarrow import fs

    to, path = file_system(target)
    folder, name = path.rsplit("/", 1)
    to.create_dir(folder, recursive=True)
    staged = f"_{uuid.uuid4().hex}.{name}"
    try:
        write(f"{target.rsplit('/', 1)[0]}/{staged}")
        to.move(f"{folder}/{staged}", path)
    except BaseException:
        if to.get_file_info(f"{folder}/{staged}").type != fs.FileType.NotFound:
            to.delete_file(f"{folder}/{staged}")
        raise


class Folder:
    """The few file operations that Spark's writers lack, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self._spark, self._path = root, spark, spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def qualified(self) -> str:
        return self._fs.makeQualified(self._path(self.root)).toString()

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(f"{self.root}/{name}"))

    def remove(self, name: str = "") -> None:
        self._fs.delete(self._path(f"{self.root}/{name}"), True)

    def parts(self, name: str) -> list[str]:
        """Data files of a folder that Spark wrote, and of its partitions."""
        found, todo = [], [f"{self.root}/{name}"]
        while todo:
            for s in self._fs.listStatus(self._path(todo.pop())):
                at = s.getPath().toString()
                if s.isDirectory():
                    todo.append(at)
                elif at.rsplit("/", 1)[-1].startswith("part-"):
                    found.append(at)
        return sorted(found)

    def rename(self, at: str, name: str) -> None:
        """Puts a file in its place, over one that is there; readers see one of the two, whole."""
        hadoop, target = self._spark._jvm.org.apache.hadoop.fs, self._path(f"{self.root}/{name}")
        self._fs.mkdirs(target.getParent())
        how = getattr(hadoop, "Options$Rename")
        options = self._spark.sparkContext._gateway.new_array(how, 1)
        options[0] = how.OVERWRITE
        files = hadoop.FileContext.getFileContext(self._fs.getUri(), self._spark._jsc.hadoopConfiguration())
        files.rename(self._fs.makeQualified(self._path(at)), self._fs.makeQualified(target), options)

    def put_lines(self, lines: DataFrame, name: str, staging: str) -> None:
        """One column of text as one file; a single task streams it."""
        lines.coalesce(1).write.text(f"{self.root}/{staging}")
        self.rename(self.parts(staging)[0], name)
        self.remove(staging)


def numbered(good: DataFrame) -> DataFrame:
    """episode and its new number, from 0 in the order of the old ones; a row per episode of the dataset."""
    return before(good.select(F.col("episode").cast("long").alias("episode")).where("episode is not null").distinct(), "episode", new=1)


def renumber_lines(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """JSON lines of the kept episodes with their new number, in its order; all other keys stay as they are."""
    d = lines.select(F.from_json("value", "map<string,variant>").alias("m"))
    d = d.withColumn("episode", F.element_at("m", F.lit("episode_index")).cast("long")).join(ids, "episode")
    rest = F.map_filter("m", lambda k, _: k != "episode_index")
    number = F.create_map(F.lit("episode_index"), F.parse_json(F.col("new").cast("string")))
    return d.select("new", F.to_json(F.map_concat(number, rest)).alias("value")).orderBy("new")


def _episode_path(folder: str, chunk: Column, *rest: Column | str, number: Column, suffix: str) -> Column:
    middle = [F.lit(x) if isinstance(x, str) else x for x in rest]
    return F.concat_ws("/", F.lit(folder), F.format_string("chunk-%03d", chunk), *middle, F.format_string(f"episode_%06d.{suffix}", number))


def copy_clips(clips: DataFrame, copy: Copy = copy_file) -> int:
    """Copies (source, target) pairs in tasks and counts them; a task that is run again writes its targets again."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for source, target in zip(b["source"], b["target"]):
                copy(source, target)
            yield pd.DataFrame({"n": [len(b)]})

    return clips.select("source", "target").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def rewritten_frames(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """All columns of the kept episodes' frames; of frame_index, episode_index and index those that exist are made anew.

    Rows keep the order of frame_index, else of timestamp or index, else as they are read. Adds ``__new``, the number of the episode.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "episode_*.parquet").option("mergeSchema", True).parquet(f"{root}/data")
    order = next((c for c in ("frame_index", "timestamp", "index") if c in raw.columns), None)
    d = raw.withColumn("__episode", datasets.episode_number(F.col("_metadata.file_name")).cast("long"))
    d = d.join(ids.select(F.col("episode").alias("__episode"), F.col("new").alias("__new")), "__episode")
    sizes = d.groupBy("__new").agg(F.count("*").alias("__n"))
    starts = before(sizes, "__new", __start=F.col("__n")).drop("__n")
    w = W.partitionBy("__new").orderBy(order) if order else W.partitionBy("__new").orderBy(F.lit(0))
    d = d.withColumn("__at", F.row_number().over(w).cast("long") - 1).join(starts, "__new")
    new = {"frame_index": F.col("__at"), "episode_index": F.col("__new"), "index": F.col("__start") + F.col("__at")}
    return d.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in raw.columns], "__new", "__at")


def save_filtered(spark: SparkSession, root: str, out: str, good: DataFrame, overwrite: bool = True, copy: Copy = copy_file) -> dict:
    """Writes the folder and returns its info document.

    Errors: the same folder twice, a folder that exists without ``overwrite``, a version
    other than v2.1 and v3.0, good episodes that the dataset lacks, and a result without
    episodes, frames or clips.
    """
    source, target = Folder(spark, root), Folder(spark, out)
    if source.qualified() == target.qualified():
        raise ValueError(f"input and output are the same folder: {root}")
    info = datasets.read_json(spark, f"{root}/meta/info.json")
    version = datasets.version(info)
    if version not in ("v2.1", "v3.0"):
        raise ValueError(f"unsupported dataset version: {version}")
    if target.exists():
        if not overwrite:
            raise FileExistsError(f"{out} exists and overwrite is off")
        target.remove()
    return (_save_v21 if version == "v2.1" else _save_v30)(spark, source, target, info, numbered(good), copy)


def _save_v21(spark: SparkSession, source: Folder, target: Folder, info: dict, ids: DataFrame, copy: Copy) -> dict:
    root, out = source.root, target.root
    size = int(info["chunks_size"])
    chunk = lambda n: F.floor(n / size)

    frames = rewritten_frames(spark, root, ids)
    staged = frames.repartition("__new").sortWithinPartitions("__new", "__at").drop("__at")
    staged.write.option("compression", "zstd").option("maxRecordsPerFile", 0).partitionBy("__new").parquet(f"{out}/_data")
    for at in target.parts("_data"):
        n = int(at.split("__new=")[1].split("/")[0])
        target.rename(at, f"data/chunk-{n // size:03d}/episode_{n:06d}.parquet")
    target.remove("_data")

    cameras = [k for k in info.get("features", {}) if "images" in k]
    clips = ids.withColumn("camera", F.explode(F.array(*[F.lit(c) for c in cameras]).cast("array<string>")))
    clips = clips.select(
        _episode_path(f"{source.qualified()}/videos", chunk(F.col("episode")), F.col("camera"), number=F.col("episode"), suffix="mp4").alias("source"),
        _episode_path(f"{target.qualified()}/videos", chunk(F.col("new")), F.col("camera"), number=F.col("new"), suffix="mp4").alias("target"),
    )
    n_clips = copy_clips(clips.repartition(spark.sparkContext.defaultParallelism), copy) if cameras else 0

    for name in ("episodes", "episodes_stats"):
        target.put_lines(renumber_lines(spark.read.text(f"{root}/meta/{name}.jsonl"), ids).select("value"), f"meta/{name}.jsonl", f"_{name}")
    target.put_lines(spark.read.text(f"{root}/meta/tasks.jsonl"), "meta/tasks.jsonl", "_tasks")

    kept = spark.read.schema("length long").json(f"{out}/meta/episodes.jsonl").agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return _finish(spark, target, info, ids, ids.count(), kept, n_clips)


def _finish(spark: SparkSession, target: Folder, info: dict, ids: DataFrame, episodes: int, frames: int, clips: int) -> dict:
    splits = spark.createDataFrame([(k, *map(int, v.split(":"))) for k, v in info.get("splits", {}).items()], "name string, start long, stop long")
    found = report.rebuild_splits(splits, ids.select("episode")).collect()
    info |= {"total_episodes": episodes, "total_frames": frames, "total_videos": clips, "splits": {r["name"]: r["range"] for r in found}}
    for key in ("total_episodes", "total_frames", "total_videos"):
        if not info[key]:
            raise ValueError(f"{key} is 0")
    target.put_lines(spark.createDataFrame([(json.dumps(info),)], "value string"), "meta/info.json", "_info")
    return info


def renumbered_meta(meta: DataFrame, ids: DataFrame, chunk_size: int) -> DataFrame:
    """The kept rows of a v3.0 episode table with new numbers, places and data files; adds ``__file`` and the old number.

    Episodes that shared a data file still do; files are numbered in the order of their first episode.
    """
    d = meta.withColumnRenamed("episode_index", "__old").join(ids.withColumnRenamed("episode", "__old"), "__old")
    first = d.groupBy("data/chunk_index", "data/file_index").agg(F.min("new").alias("__first"))
    files = before(first, "__first", __file=1).drop("__first")
    d = before(d.join(files, ["data/chunk_index", "data/file_index"]), "new", __start=F.col("length"))
    new = {
        "episode_index": F.col("new"), "dataset_from_index": F.col("__start"), "dataset_to_index": F.col("__start") + F.col("length").cast("long"),
        "data/chunk_index": F.floor(F.col("__file") / chunk_size), "data/file_index": F.col("__file") % chunk_size,
        "meta/episodes/chunk_index": F.lit(0).cast("long"), "meta/episodes/file_index": F.lit(0).cast("long"),
    }
    return d.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in meta.columns], "__old", "__file")


def _save_v30(spark: SparkSession, source: Folder, target: Folder, info: dict, ids: DataFrame, copy: Copy) -> dict:
    """Combined files: frames keep their grouping into files, clips are copied whole, since rows point into them by time."""
    root, out, size = source.root, target.root, int(info["chunks_size"])
    meta = renumbered_meta(datasets.read_meta_v30(spark, root), ids, size)
    meta.coalesce(1).sortWithinPartitions("episode_index").drop("__old", "__file").write.option("compression", "zstd").parquet(f"{out}/_meta")
    target.rename(target.parts("_meta")[0], "meta/episodes/chunk-000/file-000.parquet")
    target.remove("_meta")

    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "file-*.parquet").option("mergeSchema", True).parquet(f"{root}/data")
    places = meta.select(F.col("__old").alias("__episode"), F.col("episode_index").alias("__new"), F.col("dataset_from_index").alias("__start"), "__file")
    d = raw.withColumn("__episode", F.col("episode_index").cast("long")).join(places, "__episode")
    at = F.row_number().over(W.partitionBy("__new").orderBy("frame_index")).cast("long") - 1
    d = d.withColumn("__at", at)
    new = {"frame_index": F.col("__at"), "episode_index": F.col("__new"), "index": F.col("__start") + F.col("__at")}
    frames = d.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in raw.columns], "__file", (F.col("__start") + F.col("__at")).alias("__row"))
    staged = frames.repartition("__file").sortWithinPartitions("__file", "__row").drop("__row")
    staged.write.option("compression", "zstd").option("maxRecordsPerFile", 0).partitionBy("__file").parquet(f"{out}/_data")
    for part in target.parts("_data"):
        n = int(part.split("__file=")[1].split("/")[0])
        target.rename(part, f"data/chunk-{n // size:03d}/file-{n % size:03d}.parquet")
    target.remove("_data")

    written = datasets.read_meta_v30(spark, out)
    cameras = [c.split("/")[1] for c in written.columns if c.startswith("videos/") and c.endswith("/chunk_index")]
    names = [F.format_string(f"videos/{c}/chunk-%03d/file-%03d.mp4", F.col(f"`videos/{c}/chunk_index`").cast("long"), F.col(f"`videos/{c}/file_index`").cast("long")) for c in cameras]
    n_clips = 0
    if names:
        clips = written.select(F.explode(F.array(*names)).alias("name")).distinct()
        n_clips = copy_clips(clips.select(F.concat(F.lit(f"{source.qualified()}/"), "name").alias("source"), F.concat(F.lit(f"{target.qualified()}/"), "name").alias("target")), copy)
    for name in ("tasks.parquet", "stats.json"):
        if source.exists(f"meta/{name}"):
            copy(f"{source.qualified()}/meta/{name}", f"{target.qualified()}/meta/{name}")
    n, total = written.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return _finish(spark, target, info, ids, n, total, n_clips)
